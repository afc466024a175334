"""Clean layers and those with early orders from one pass."""

import pytest
from pyspark.sql import functions as F

from stratalake.plans import queries as Q
from stratalake.plans import silver as S
from stratalake.sources import fixtures as fx
from stratalake.sources.schemas import BRONZE, EXTRACT_DATE, INGESTED_AT


def _odd_tables(spark, folder):
    """Orders and lines whose keys repeat or are null, of old and new customers, early and late."""
    day = lambda m: F.element_at(F.array(*[F.lit(d) for d in ("1994-05-01", "1996-05-01", "1998-05-01")]), m).cast("timestamp_ntz")
    n = spark.range(60)
    n.select(F.when(F.col("id") % 20 != 7, F.col("id") % 23).alias("o_orderkey"),
             F.when(F.col("id") % 11 != 3, F.col("id") * 7 % 100).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
             F.when(F.col("id") % 13 != 4, day((F.col("id") % 3 + 1).cast("int"))).alias("o_orderdate")).unionByName(
        n.select((F.col("id") % 23).alias("o_orderkey"), F.lit(49).cast("long").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
                 day((F.col("id") % 3 + 1).cast("int")).alias("o_orderdate"))).unionByName(
        # early orders that the clean variant has not
        spark.range(100, 105).select(F.col("id").alias("o_orderkey"), F.lit(49).cast("long").alias("o_custkey"),
                                     F.lit("F").alias("o_orderstatus"), day(F.lit(1)).alias("o_orderdate"))).coalesce(1).write.parquet(f"{folder}/orders.parquet")
    spark.range(150).select(
        F.when(F.col("id") < 140, F.col("id") % 25).otherwise(F.col("id") % 5 + 100).alias("l_orderkey"), (F.col("id") % 9).alias("l_partkey"), (F.col("id") % 4).cast("int").alias("l_linenumber"),
        (F.col("id") % 7).cast("double").alias("l_quantity"), (F.col("id") / 4).alias("l_extendedprice")).coalesce(1).write.parquet(
        f"{folder}/lineitem.parquet")


@pytest.mark.parametrize("table", ["orders", "order_items"])
def test_newest_rows_of_both_variants_at_once(spark, scratch, table):
    _odd_tables(spark, scratch)
    cols = [c for c in BRONZE[table].fieldNames() if c not in (EXTRACT_DATE, INGESTED_AT)]
    both = S.newest_rows_where(fx.bronze_of_both(spark, scratch, table), table, fx.IN_CLEAN)
    for flag, variant in (("__some", "clean"), ("__all", "early_new_orders")):
        want = S.newest_rows(fx.bronze_history(spark, scratch, table, None, variant), table).select(*cols)
        got = both.where(flag).select(*cols)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())), variant
    assert both.where("__all AND NOT __some").count() > 0 and both.where("__all AND __some").count() > 0


def test_hot_key_is_reduced_before_the_shuffle(spark, scratch):
    _odd_tables(spark, scratch)
    rows = fx.bronze_of_both(spark, scratch, "orders").withColumn("order_id", F.col("order_id") * 0)
    plan = S.newest_rows_where(rows, "orders", fx.IN_CLEAN)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning(order_id") < plan.index("partial_min")


def test_breaks_build_lines_once_for_both_variants(spark, sf):
    clean, early = Q.stored_variants(spark, sf)
    assert early.silver["customers"] is clean.silver["customers"]
    assert early.dim_customer is clean.dim_customer
    apart = Q.StoredChain(spark, sf, variant="early_new_orders").recon()
    assert early.recon().collect() == apart.collect()
    assert clean.recon().collect() == Q.StoredChain(spark, sf).recon().collect()
