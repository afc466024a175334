"""Contracts (Q1-Q5) and model tests (DT1-DT5): clean passes, faults fail."""

import datetime

from pyspark.sql import functions as F

from stratalake.operators import contracts as C
from stratalake.plans.queries import Chain, bogus_segment_copy


def _failed(report):
    return {(t, r, c) for t, r, c, _ in C.failed_rules(report)}


def test_clean_silver_passes(spark, sf):
    rep = C.suite_report(Chain(spark, sf).silver)
    assert rep.count() == 14
    assert C.failed_rules(rep) == []


def test_bogus_segment_is_caught(spark, sf):
    s = Chain(spark, sf).silver
    bad = dict(s, customers=bogus_segment_copy(s["customers"]))
    assert _failed(C.suite_report(bad)) == {("customers", "in_set", "segment"),
                                            ("customers", "unique", "customer_id")}


def test_null_id_and_city_are_caught(spark, sf):
    s = Chain(spark, sf).silver
    cust = s["customers"].withColumn(
        "city", F.when(F.col("customer_id") % 7 == 0, F.lit(None)).otherwise(F.col("city")))
    nulls = spark.createDataFrame([(None, "x", "SMB", "Y", "2020-01-01 00:00:00")],
                                  cust.schema)
    rep = C.suite_report(dict(s, customers=cust.unionByName(nulls)))
    assert {("customers", "not_null", "city"), ("customers", "not_null", "customer_id")} \
        <= _failed(rep)


def test_duplicate_order_and_zero_quantity_are_caught(spark, sf):
    s = Chain(spark, sf).silver
    orders = s["orders"].unionByName(s["orders"].orderBy("order_id").limit(1))
    items = s["order_items"].withColumn(
        "quantity", F.when(F.col("order_item_id") % 5 == 0, F.lit(0).cast("bigint"))
        .otherwise(F.col("quantity")))
    rep = C.suite_report(dict(s, orders=orders, order_items=items))
    assert _failed(rep) == {("orders", "unique", "order_id"),
                            ("order_items", "between", "quantity")}
    n = {(r.table_name, r.rule): r.violations for r in rep.collect()}
    assert n[("orders", "unique")] == 2


def test_gold_model_tests_pass_and_catch_unknown_product(spark, sf):
    g = Chain(spark, sf).gold
    assert C.failed_rules(C.model_test_report(g)) == []
    fact = g["fact_sales"].withColumn(
        "product_sk", F.when(F.col("order_item_id") == g["fact_sales"].agg(
            F.min("order_item_id")).scalar(), F.lit(-1).cast("bigint"))
        .otherwise(F.col("product_sk")))
    rep = C.model_test_report(dict(g, fact_sales=fact))
    assert _failed(rep) == {("fact_sales", "relationships", "product_sk")}


def test_relationships_count_every_rule_in_one_pass(spark):
    fact = spark.createDataFrame([("a", 1), ("a", 9), ("z", 1), (None, 9), ("z", None)], "c string, p int")
    refs = {"cust": spark.createDataFrame([("a",), ("a",), (None,)], "k string"),
            "prod": spark.createDataFrame([(1,), (2,)], "k long")}
    rules = [C.relationships("c", "cust", "k"), C.relationships("p", "prod", "k")]
    rep = {r.column_name: r.violations for r in C.evaluate(fact, "f", rules, refs).collect()}
    assert rep == {"c": 2, "p": 2}
    plan = C.orphan_rows(fact, rules, refs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD [c") == 1
    assert C.failed_rules(C.evaluate(fact.where("c = 'a' and p = 1"), "f", rules, refs)) == []


def test_two_open_versions_fail_singular_test(spark, sf):
    g = Chain(spark, sf).gold
    dim = g["dim_customer"]
    k = dim.where("not is_current").agg(F.min("customer_id")).scalar()
    reopened = dim.withColumn("is_current", F.col("is_current") | (F.col("customer_id") == k))
    rep = C.model_test_report(dict(g, dim_customer=reopened))
    assert ("dim_customer", "one_current_version", "customer_id") in _failed(rep)


def test_nulls_pass_set_and_range_rules(spark):
    df = spark.createDataFrame([(None, None), ("SMB", 1)], "segment string, quantity long")
    rep = C.evaluate(df, "t", [C.in_set("segment", C.SEGMENTS), C.between("quantity", 1)])
    assert C.failed_rules(rep) == []
    assert datetime  # keep import used
