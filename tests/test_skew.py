"""A key holding a third of all rows must not end up in one task."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from stratalake.operators.dedup import latest_per_key
from stratalake.operators.joins import pit_join
from stratalake.operators.windows import next_in_key

from .conftest import rows

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _with_conf(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot_facts(spark, n=300_000):
    return spark.range(n).select(
        F.col("id").alias("fid"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("k"),
        (F.lit("2020-01-01").cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.col("id") % 24)).alias("ts"))


def test_pit_join_splits_a_hot_key(spark):
    old = _with_conf(spark, SKEW_CONF)
    try:
        facts = _hot_facts(spark)
        vers = spark.range(1000).select(
            F.col("id").alias("k"),
            (F.lit("2019-01-01").cast("timestamp_ntz")
             + F.make_dt_interval(F.col("id") % 2)).alias("valid_from"),
            F.lit(None).cast("timestamp_ntz").alias("valid_to"),
            F.concat(F.lit("v"), F.col("id").cast("string")).alias("vid"))
        out = pit_join(facts, vers, key="k", ts="ts", version_cols=["vid"])
        got = out.collect()
        assert len(got) == 300_000 and all(r.vid is not None for r in got)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        _restore(spark, old)


def test_dedup_cuts_a_hot_key_before_the_shuffle(spark):
    facts = _hot_facts(spark, 30_000)
    out = latest_per_key(facts, "k", ["-ts", "fid"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    # tree strings list parents first: the Partial limit sits below the Exchange
    assert "Final" in plan and "Partial" in plan
    assert plan.index("Exchange") < plan.index("Partial")
    assert out.count() == 1000


def test_next_in_key_equals_plain_lead(spark):
    random.seed(5)
    data = []
    for i in range(3000):
        user = 1 if i % 3 == 0 else random.randint(2, 40)   # user 1 holds a third
        data.append((i, user, f"2024-01-0{1 + random.randint(0, 4)} "
                              f"{random.randint(0, 23):02d}:{random.randint(0, 59):02d}:00"))
    data += [(5000, None, "2024-01-01 05:00:00"), (5001, None, "2024-01-03 07:00:00"),
             (5002, None, None), (5003, 1, None)]      # null keys form a group, like lead()
    df = spark.createDataFrame(data, "event_id long, user_id long, ts string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    want = df.withColumn("next_ts", F.lead("ts").over(
        Window.partitionBy("user_id").orderBy("ts", "event_id")))
    got = next_in_key(df, "user_id", "ts", "event_id", F.date_trunc("hour", "ts"))
    assert rows(got, "event_id", "next_ts") == rows(want, "event_id", "next_ts")
    # hot hours cut into time slices: still exactly lead()
    cut = next_in_key(df, "user_id", "ts", "event_id", F.date_trunc("hour", "ts"),
                      max_bucket_rows=5)
    assert rows(cut, "event_id", "next_ts") == rows(want, "event_id", "next_ts")


def test_asof_join_hot_key_equals_window_join(spark):
    """A user with a third of all rows (and many same-second ties): the as-of
    join equals the half-open window join on the signup chain."""
    from stratalake.operators.joins import asof_join
    random.seed(7)
    data = []
    for i in range(6000):
        user = 1 if i % 3 == 0 else random.randint(2, 60)
        kind = "signup" if random.random() < 0.3 else "purchase"
        data.append((i, user, kind, f"2024-01-0{1 + random.randint(0, 4)} "
                                    f"{random.randint(0, 23):02d}:{random.randint(0, 59):02d}:"
                                    f"{random.randint(0, 1):02d}"))
    ev = spark.createDataFrame(data, "event_id long, user_id long, event_type string, ts string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    sign = ev.where("event_type = 'signup'").select(F.col("event_id").alias("sid"), "user_id", "ts")
    facts = ev.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    chain = sign.select("sid", "user_id", F.col("ts").alias("valid_from"),
                        F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts", "sid"))
                        .alias("valid_to"))
    want = pit_join(facts, chain, key="user_id", ts="ts", version_cols=["sid"])
    got = asof_join(facts, sign, key="user_id", ts="ts", tie="sid", version_cols=["sid"])
    assert rows(got) == rows(want)


def test_relationships_rule_moves_one_row_per_key(spark):
    """A key held by a third of the rows: the rule counts per key value
    map-side, so no join ever sees the table's rows, whether or not the
    referenced keys are small enough to broadcast."""
    from stratalake.operators.contracts import evaluate, relationships
    facts = _hot_facts(spark, 30_000).withColumn(
        "k", F.when(F.col("fid") == 5, F.lit(5_000)).otherwise(F.col("k")))   # one orphan row
    dim = spark.range(1000).select(F.col("id").alias("k"))
    old = _with_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"})
    try:
        rep = evaluate(facts, "f", [relationships("k", "dim", "k")], refs={"dim": dim})
        assert rows(rep, "rule", "column_name", "violations") == [("relationships", "k", 1)]
        plan = rep._jdf.queryExecution().executedPlan().toString()
        assert "ExistenceJoin" not in plan
        # the anti join's fact side is the per-value count, partially aggregated
        assert "partial_count" in plan
    finally:
        _restore(spark, old)
    # the same plan with broadcasts on: no join sees more rows than distinct values
    rep = evaluate(facts, "f", [relationships("k", "dim", "k")], refs={"dim": dim})
    assert rows(rep, "rule", "column_name", "violations") == [("relationships", "k", 1)]
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert "ExistenceJoin" not in plan and "partial_count" in plan


def test_asof_join_cuts_a_hot_bucket(spark):
    """One user's single minute holds most rows (with same-microsecond ties):
    the bucket is cut into time slices and the result is still exact."""
    from stratalake.operators.joins import asof_join
    random.seed(11)
    data = []
    for i in range(6000):
        hot = i % 3 != 0
        user = 1 if hot else random.randint(2, 30)
        kind = "signup" if random.random() < 0.25 else "purchase"
        sec = random.randint(0, 59)
        micro = random.choice([0, 0, 0, random.randint(0, 999_999)])   # many exact ties
        minute = 7 if hot else random.randint(0, 59)
        data.append((i, user, kind, f"2024-01-01 03:{minute:02d}:{sec:02d}.{micro:06d}"))
    ev = spark.createDataFrame(data, "event_id long, user_id long, event_type string, ts string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    sign = ev.where("event_type = 'signup'").select(F.col("event_id").alias("sid"), "user_id", "ts")
    facts = ev.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    chain = sign.select("sid", "user_id", F.col("ts").alias("valid_from"),
                        F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts", "sid"))
                        .alias("valid_to"))
    want = rows(pit_join(facts, chain, key="user_id", ts="ts", version_cols=["sid"]))
    cut = asof_join(facts, sign, key="user_id", ts="ts", tie="sid", version_cols=["sid"],
                    max_bucket_rows=300)
    whole = asof_join(facts, sign, key="user_id", ts="ts", tie="sid", version_cols=["sid"],
                      max_bucket_rows=None)
    assert rows(cut) == want
    assert rows(whole) == want
