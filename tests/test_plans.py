"""Plan shape of every registered query: no cross joins, no Python UDFs, no
shuffled existence joins, pruned scans."""

import re

import pytest

from stratalake.plans.queries import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_or_python_in_plan(spark, sf, name):
    plan = _plan(QUERIES[name](spark, sf))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"
    # AQE does not split a skewed existence join: only broadcast ones are allowed
    for line in plan.splitlines():
        if "ExistenceJoin" in line:
            assert "BroadcastHashJoin" in line, f"{name}: {line.strip()}"


def test_lineitem_scan_is_pruned(spark, sf):
    plan = _plan(QUERIES["fact_sales"](spark, sf))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    li = [s for s in schemas if "l_orderkey" in s]
    assert li and all("l_shipdate" not in s and "l_discount" not in s for s in li)


def test_events_scan_reads_only_needed_columns(spark, sf):
    plan = _plan(QUERIES["pit_events"](spark, sf))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas and all("props" not in s for s in schemas)


def test_small_single_file_source_is_spread(spark, tmp_path):
    """A source in one row group is spread over the cores after its scan;
    tiny and large sources are read as they are."""
    from pyspark.sql import functions as F
    from stratalake.sources.tables import spread_small
    path = str(tmp_path / "one.parquet")
    spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h")) \
        .coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    spread = spread_small(spark, df, min_bytes=1, max_bytes=1 << 30)
    assert "RoundRobinPartitioning" in _plan(spread)
    assert spread_small(spark, df, min_bytes=1 << 40) is df        # too small to bother
    assert spread_small(spark, df, min_bytes=1, max_bytes=10) is df  # too large to move
    assert spread.where("id < 10").count() == 10


def test_event_versions_join_has_no_range_condition(spark, sf):
    """pit_events resolves versions with the as-of join: every join is a
    pure equi join, so no purchase is compared with many signups."""
    plan = _plan(QUERIES["pit_events"](spark, sf))
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all(">=" not in j and "<" not in j for j in joins)
