"""Keyed state in bucketed tables."""

import glob
import os
import random

import pytest

from stratalake.operators.dedup import latest_per_key
from stratalake.sources.bucketed import BucketedState
from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType([StructField("k", LongType()), StructField("t", LongType()), StructField("v", StringType())])
ORDER = ["-t", "v"]


@pytest.fixture()
def state(spark, scratch):
    return BucketedState(spark, f"{scratch}/state", SCHEMA, "k", ORDER, parts=4, buckets=2)


def _files(state):
    return set(glob.glob(f"{state.path}/**/*.parquet", recursive=True))


@pytest.mark.parametrize("seed", [1, 2])
def test_merges_in_any_order_give_the_newest_row(spark, state, seed):
    """Null keys, times and values, ties, and a batch sent twice."""
    rng = random.Random(seed)
    batches = [[(rng.choice([*range(25), None]), rng.choice([None, 1, 2, 3]), rng.choice(["a", "b", None]))
                for _ in range(30)] for _ in range(4)]
    every = []
    for rows in [*batches, batches[1]]:
        df = spark.createDataFrame(rows, SCHEMA)
        every += rows
        state.merge(latest_per_key(df, "k", ORDER))
    want = latest_per_key(spark.createDataFrame(every, SCHEMA), "k", ORDER)
    assert sorted(map(repr, state.rows().collect())) == sorted(map(repr, want.collect()))


def test_only_touched_parts_are_written_and_the_state_is_not_shuffled(spark, state):
    state.merge(spark.createDataFrame([(i, 1, "a") for i in range(200)], SCHEMA))
    before = _files(state)
    one = spark.createDataFrame([(7, 2, "b"), (8, 0, "old")], SCHEMA)
    parts = state.merge(one)
    assert len(parts) == 1
    kept = {f for f in before if f"_p={min(parts)}{os.sep}" not in f}
    assert kept <= _files(state) and not (before - kept) & _files(state)
    assert state.merge(one) == set()
    plan = state.merged(one, [0, 1, 2, 3])._jdf.queryExecution().executedPlan().toString()
    scans = [i for i, ln in enumerate(plan.splitlines()) if "Bucketed: true" in ln]
    lines = plan.splitlines()
    join = next(i for i, ln in enumerate(lines) if "SortMergeJoin" in ln)
    # between the join and the state's scan there is no exchange; the batch has the only one
    assert scans and not any("Exchange" in ln for ln in lines[join:scans[0]])
    assert plan.count("Exchange hashpartitioning") == 1


def test_state_is_found_again_by_its_path(spark, state):
    state.merge(spark.createDataFrame([(1, 1, "a")], SCHEMA))
    spark.sql(f"DROP TABLE {state.name}")       # a new session knows no table
    again = BucketedState(spark, state.path, SCHEMA, "k", ORDER, parts=4, buckets=2)
    again.merge(spark.createDataFrame([(2, 1, "b")], SCHEMA))
    assert sorted(r["k"] for r in again.rows().collect()) == [1, 2]
