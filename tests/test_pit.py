"""Point-in-time join semantics."""

import datetime as dt

import pytest

from stratalake.operators.joins import pit_join
from stratalake.plans.queries import pit_events

from .conftest import rows


def _ts(d, h=0):
    return dt.datetime(2020, 1, d, h)


def test_half_open_windows_and_open_end(spark):
    versions = spark.createDataFrame([
        (1, "v1", _ts(1), _ts(5)),
        (1, "v2", _ts(5), None),
        (2, "w1", _ts(3), None),
    ], "k long, vid string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    facts = spark.createDataFrame([
        (10, 1, _ts(1)),      # at valid_from -> v1
        (11, 1, _ts(4, 23)),  # inside v1
        (12, 1, _ts(5)),      # at boundary -> v2 (upper bound open)
        (13, 1, _ts(28)),     # open-ended current version
        (14, 2, _ts(2)),      # before first version -> unresolved
        (15, 3, _ts(2)),      # unknown key -> unresolved
    ], "fid long, k long, ts timestamp_ntz")
    out = pit_join(facts, versions, key="k", ts="ts", version_cols=["vid"])
    assert rows(out, "fid", "vid") == [(10, "v1"), (11, "v1"), (12, "v2"), (13, "v2"),
                                       (14, None), (15, None)]


def test_without_open_end_current_versions_are_lost(spark):
    versions = spark.createDataFrame([(1, "v", _ts(1), None)],
                                     "k long, vid string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    facts = spark.createDataFrame([(10, 1, _ts(2))], "fid long, k long, ts timestamp_ntz")
    out = pit_join(facts, versions, key="k", ts="ts", version_cols=["vid"], open_upper=False)
    assert rows(out, "fid", "vid") == [(10, None)]


def test_events_every_purchase_kept_once(spark, sf):
    out = pit_events(spark, sf)
    from pyspark.sql import functions as F
    ev = spark.read.parquet(f"{sf}/events.parquet")
    n = ev.where(F.col("event_type") == "purchase").count()
    assert out.count() == n == out.select("event_id").distinct().count()


def test_asof_equals_pit_join_on_signup_chains(spark, sf):
    """The as-of resolution of purchases equals the half-open window join on
    the signup versions (the chain each signup starts)."""
    from pyspark.sql import functions as F
    from stratalake.plans.queries import signup_versions
    ev = spark.read.parquet(f"{sf}/events.parquet")
    purchases = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")
    want = pit_join(purchases, signup_versions(ev), key="user_id", ts="ts",
                    version_cols=["signup_event_id"])
    got = pit_events(spark, sf)
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_asof_ties_gaps_and_nulls(spark):
    """Equal start times resolve to the last start by tie; a fact at a start
    time takes that start; facts before any start, with unknown keys or null
    times stay unresolved; buckets without starts look back across buckets."""
    from stratalake.operators.joins import asof_join
    starts = spark.createDataFrame([
        (1, 100, _ts(1)), (1, 101, _ts(1)),      # tie at the same instant -> 101 wins
        (1, 102, _ts(5, 7)),
        (2, 200, _ts(3)),
        (None, 300, _ts(1)), (2, 301, None),     # ignored: null key / null time
    ], "k long, sid long, ts timestamp_ntz")
    facts = spark.createDataFrame([
        (10, 1, _ts(1)),      # at the tied start -> 101
        (11, 1, _ts(4, 23)),  # other bucket, looks back -> 101
        (12, 1, _ts(5, 7)),   # exactly at 102
        (13, 1, _ts(28)),     # far later -> 102
        (14, 2, _ts(2)),      # before the key's first start -> null
        (15, 3, _ts(2)),      # unknown key -> null
        (16, 1, None),        # null time -> null
        (17, None, _ts(9)),   # null key -> null
    ], "fid long, k long, ts timestamp_ntz")
    out = asof_join(facts, starts, key="k", ts="ts", tie="sid", version_cols=["sid"])
    assert out.columns == ["fid", "k", "ts", "sid"]
    assert rows(out, "fid", "sid") == [(10, 101), (11, 101), (12, 102), (13, 102),
                                       (14, None), (15, None), (16, None), (17, None)]


def test_asof_within_one_table(spark):
    """Facts and starts from one table: starts never come out as facts (also
    those without key or time), facts without key or time stay unresolved."""
    from pyspark.sql import functions as F
    from stratalake.operators.joins import asof_within
    ev = spark.createDataFrame([
        (1, 1, "s", _ts(1)), (2, 1, "p", _ts(2)), (3, 1, "s", _ts(3)), (4, 1, "p", _ts(3)),
        (5, None, "s", _ts(1)), (6, 1, "s", None),          # unusable starts: dropped
        (7, None, "p", _ts(4)), (8, 1, "p", None),          # facts without key / time
        (9, 2, "p", _ts(5)),                                 # key without starts
    ], "eid long, k long, kind string, ts timestamp_ntz")
    out = asof_within(ev, key="k", ts="ts", is_start=F.col("kind") == "s", tie="eid",
                      fact_cols=["eid", "k", "ts"], versions={"sid": F.col("eid")})
    assert out.columns == ["eid", "k", "ts", "sid"]
    assert rows(out, "eid", "sid") == [(2, 1), (4, 3), (7, None), (8, None), (9, None)]


def _windows(spark, seed, overlap):
    import random
    rng = random.Random(seed)
    vs = []
    for k in range(30):
        t, n = 0, 0
        for _ in range(rng.randint(0, 6)):
            start = t + rng.randint(0, 3)
            end = start + rng.randint(0, 4)
            if overlap and rng.random() < 0.3:
                start = max(0, start - 3)
            vs.append((k, f"{k}-{n}", start, end))
            t, n = max(t, end), n + 1
        if rng.random() < 0.5:
            vs.append((k, f"{k}-open", t, None))
        if rng.random() < 0.2:
            vs.append((k, f"{k}-null", None, 9))
    facts = [(i, rng.choice([*range(32), None]), rng.choice([*range(30), None])) for i in range(400)]
    day = "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, {})"
    v = spark.createDataFrame(vs, "k int, sk string, f int, t int").selectExpr(
        "k", "sk", f"{day.format('f')} AS valid_from", f"{day.format('t')} AS valid_to")
    f = spark.createDataFrame(facts, "id int, k int, d int").selectExpr("id", "k", f"{day.format('d')} AS ts")
    return f, v


@pytest.mark.parametrize("seed,overlap", [(1, False), (2, True), (3, True)])
def test_sweep_join_equals_the_range_join(spark, seed, overlap):
    """With gaps, empty windows, open ends, null keys, times and starts; overlapping windows fan out."""
    from stratalake.operators.joins import overlapping_keys, pit_join, sweep_join
    f, v = _windows(spark, seed, overlap)
    want = sorted(map(repr, pit_join(f, v, "k", "ts", version_cols=["sk"]).collect()))
    got = sweep_join(f, v, "k", "ts", ["sk"])
    assert sorted(map(repr, got.collect())) == want
    assert (len(want) > 400) == overlap == (overlapping_keys(v, "k").count() > 0)
    cut = sweep_join(f, v, "k", "ts", ["sk"], max_bucket_rows=3)
    assert sorted(map(repr, cut.collect())) == want


def test_a_key_of_very_many_versions_stays_linear(spark):
    """100,000 versions and as many facts of one customer: compared pairwise, ten billion pairs."""
    import time
    from pyspark.sql import functions as F
    from stratalake.operators.joins import sweep_join
    at = F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id AS int) * 10, 0)")
    v = spark.range(100_000).select(F.lit(1).alias("k"), F.col("id").alias("sk"), at.alias("valid_from"),
                                    (at + F.expr("INTERVAL 10 MINUTES")).alias("valid_to"))
    f = spark.range(100_000).select("id", F.lit(1).alias("k"), (at + F.expr("INTERVAL 3 MINUTES")).alias("ts"))
    began = time.time()
    out = sweep_join(f, v, "k", "ts", ["sk"], bucket=lambda c: F.date_trunc("day", c))
    assert out.where("sk = id").count() == 100_000 == out.count()
    assert time.time() - began < 120
