"""The derived extracts: determinism, injected mess, change semantics."""

from pyspark.sql import functions as F

from stratalake.sources import fixtures as fx

from .conftest import rows


def test_extract_is_deterministic(spark, sf):
    a = rows(fx.raw_extract(spark, sf, "customers", 2))
    b = rows(fx.raw_extract(spark, sf, "customers", 2))
    assert a == b and len(a) > 0


def test_mess_is_present(spark, sf):
    c = fx.bronze_history(spark, sf, "customers")
    assert c.where(F.col("segment") != F.upper(F.trim("segment"))).count() > 0
    assert c.where(F.col("city").isNull()).count() > 0
    dups = c.groupBy("customer_id", "_ingested_at").count().where("count > 1")
    assert dups.count() > 0
    o = fx.bronze_history(spark, sf, "orders")
    assert o.where(F.col("status").isNull()).count() > 0
    assert o.where(F.col("customer_id") < 0).count() > 0
    i = fx.bronze_history(spark, sf, "order_items")
    assert i.where(F.col("quantity") == 0).count() > 0


def test_unchanged_customers_keep_updated_at(spark, sf):
    c = fx.bronze_history(spark, sf, "customers")
    per_key = c.groupBy("customer_id").agg(F.countDistinct("updated_at").alias("n"))
    stable = per_key.where((F.col("customer_id") % 10).isin(3, 6) == F.lit(False))
    assert stable.where("n > 1").count() == 0


def test_single_batch_equals_history_slice(spark, sf):
    one = rows(fx.raw_extract(spark, sf, "orders", 2))
    hist = fx.bronze_history(spark, sf, "orders").where(F.col("_extract_date") == "1997-01-01")
    assert one == rows(hist.select("order_id", "customer_id", "order_ts", "status"))


def test_batch_scan_pushes_date_filter(spark, sf):
    plan = fx.raw_extract(spark, sf, "orders", 2)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "o_orderdate" in plan.split("PushedFilters")[1][:300]
