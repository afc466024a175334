"""Looking up a batch's keys in a large stored table: range predicate and Bloom filter before the shuffle."""

from pyspark.sql import functions as F

from stratalake.operators.joins import keep_matching, lookup_keys

from .conftest import rows
from .test_skew import _restore, _with_conf

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    # the library leaves this at Spark's 10 GB: smaller tables are not worth a filter
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
}


def _shuffled(df):
    """Rows written by all shuffles of a plan that has run."""
    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        own = 0
        if name == "ShuffleExchangeExec":
            own = node.metrics().apply("shuffleRecordsWritten").value()
        kids = node.children()
        return own + sum(walk(kids.apply(i)) for i in range(kids.size()))
    df.collect()
    return walk(df._jdf.queryExecution().executedPlan())


def _tables(spark, tmp_path):
    n = 200_000
    spark.range(n).select((F.col("id") * 7919 % n).alias("k"), (F.col("id") % 50).alias("m")) \
        .write.parquet(str(tmp_path / "state"))
    spark.range(300).select((F.col("id") * 650 + 3).alias("k")).union(
        spark.range(1).select(F.lit(None).cast("long"))).write.parquet(str(tmp_path / "keys"))
    return spark.read.parquet(str(tmp_path / "state")), spark.read.parquet(str(tmp_path / "keys"))


def test_bloom_filter_before_the_shuffle(spark, tmp_path):
    state, keys = _tables(spark, tmp_path)
    old = _with_conf(spark, CONF)
    try:
        got = lookup_keys(state, keys, "k")
        plain = keep_matching(state, keys, "k")
        moved, all_moved = _shuffled(got), _shuffled(plain)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "might_contain" in plan and "bloom_filter_agg" in plan
        assert rows(got) == rows(plain) and got.count() == 300
        # the state moves its matches and the filter's few errors, not its 200,000 rows
        assert all_moved >= 200_000 and moved < 10_000
    finally:
        _restore(spark, old)


def test_range_of_the_keys_reaches_the_scan(spark, tmp_path):
    state, keys = _tables(spark, tmp_path)
    got = lookup_keys(state, keys.where("k < 2000"), "k")
    plan = got._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.splitlines() if "ReadSchema" in ln and "k:bigint,m:bigint" in ln]
    assert scan and "GreaterThanOrEqual(k,3)" in scan[0] and "LessThanOrEqual(k,1953)" in scan[0]


def test_odd_keys(spark):
    state = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (3, "d")], "k long, v string")
    keys = spark.createDataFrame([(1,), (1,), (None,), (9,)], "k long")
    assert rows(lookup_keys(state, keys, "k")) == [(1, "a"), (1, "b")]
    assert lookup_keys(state, keys.where("k IS NULL"), "k").count() == 0
    assert lookup_keys(state, keys.limit(0), "k").count() == 0
    text = spark.createDataFrame([("x'\\", 1), ("y", 2)], "k string, v int")
    assert rows(lookup_keys(text, text.select("k").where("v = 1"), "k")) == [("x'\\", 1)]
