"""Silver invariants on the derived lake and the refine traps (T-a ... T-e)."""

import decimal

from pyspark.sql import functions as F

from stratalake.plans import silver as S
from stratalake.plans.queries import Chain
from stratalake.sources.schemas import BRONZE

from .conftest import rows


def _bronze(spark, table, data):
    return spark.createDataFrame(data, BRONZE[table])


def test_cleaning_and_referential_integrity(spark, sf):
    s = Chain(spark, sf).silver
    c = s["customers"]
    assert c.count() == c.select("customer_id").distinct().count()
    assert c.where(~F.col("segment").isin("SMB", "MID", "ENT")).count() == 0
    assert c.where(F.col("city").isNull()).count() == 0
    o = s["orders"]
    assert o.where(F.col("status").isNull()).count() == 0
    assert o.join(c, "customer_id", "left_anti").count() == 0
    i = s["order_items"]
    assert i.where(F.col("quantity") <= 0).count() == 0
    assert i.join(o, "order_id", "left_anti").count() == 0
    assert i.join(s["products"], "product_id", "left_anti").count() == 0


def _ts(s):
    import datetime
    return datetime.datetime.fromisoformat(s)


def _d(s):
    import datetime
    return datetime.date.fromisoformat(s)


def test_filters_apply_after_dedup(spark):
    # T-a: the newest row has a null status -> the order is dropped even though
    # an older row was valid
    cust = _bronze(spark, "customers", [(1, "n", "smb", "X", "2020-01-01 00:00:00",
                                         _d("2020-01-01"), _ts("2020-01-01 01:00:00"))])
    orders = _bronze(spark, "orders", [
        (10, 1, "2020-01-01 00:00:00", "PAID", _d("2020-01-01"), _ts("2020-01-01 01:00:00")),
        (10, 1, "2020-01-01 00:00:00", None, _d("2020-01-02"), _ts("2020-01-02 01:00:00")),
    ])
    out = S.refine_orders(orders, S.refine_customers(cust))
    assert out.count() == 0


def test_latest_ingest_wins_over_later_extract_date(spark):
    # T-b: re-ingesting an old extract makes its values current
    data = [
        (1, "new", "smb", "A", "2020-02-01 00:00:00", _d("2020-02-01"), _ts("2020-02-01 01:00:00")),
        (1, "old", "smb", "B", "2020-01-01 00:00:00", _d("2020-01-01"), _ts("2020-03-01 01:00:00")),
    ]
    out = S.refine_customers(_bronze(spark, "customers", data))
    assert rows(out, "name", "city") == [("old", "B")]


def test_null_city_in_newest_row_becomes_unknown(spark):
    # T-c: newest row, not newest non-null value
    data = [
        (1, "n", " mid", "A", "2020-01-01 00:00:00", _d("2020-01-01"), _ts("2020-01-01 01:00:00")),
        (1, "n", " mid", None, "2020-01-01 00:00:00", _d("2020-01-02"), _ts("2020-01-02 01:00:00")),
    ]
    out = S.refine_customers(_bronze(spark, "customers", data))
    assert rows(out, "segment", "city") == [("MID", "UNKNOWN")]


def test_absent_keys_persist(spark):
    # T-e: a key missing from a later full extract stays in silver
    data = [
        (1, "a", "smb", "A", "2020-01-01 00:00:00", _d("2020-01-01"), _ts("2020-01-01 01:00:00")),
        (2, "b", "smb", "B", "2020-01-01 00:00:00", _d("2020-01-01"), _ts("2020-01-01 01:00:00")),
        (1, "a", "smb", "A", "2020-01-01 00:00:00", _d("2020-01-02"), _ts("2020-01-02 01:00:00")),
    ]
    out = S.refine_customers(_bronze(spark, "customers", data))
    assert rows(out, "customer_id") == [(1,), (2,)]


def test_cascade_drops_lines_of_dropped_orders(spark):
    cust = _bronze(spark, "customers", [(1, "n", "smb", "X", "2020-01-01 00:00:00",
                                         _d("2020-01-01"), _ts("2020-01-01 01:00:00"))])
    D = decimal.Decimal
    prod = _bronze(spark, "products", [(7, "p", "HW", D("1.50"), _d("2020-01-01"),
                                        _ts("2020-01-01 01:00:00"))])
    orders = _bronze(spark, "orders", [
        (10, 1, "2020-01-01 00:00:00", "PAID", _d("2020-01-01"), _ts("2020-01-01 01:00:00")),
        (11, 99, "2020-01-01 00:00:00", "PAID", _d("2020-01-01"), _ts("2020-01-01 01:00:00")),
    ])
    items = spark.createDataFrame([
        (100, 10, 7, 1, D("1.50"), _d("2020-01-01"), _ts("2020-01-01 01:00:00")),
        (110, 11, 7, 1, D("1.50"), _d("2020-01-01"), _ts("2020-01-01 01:00:00")),
        (101, 10, 8, 1, D("1.50"), _d("2020-01-01"), _ts("2020-01-01 01:00:00")),
        (102, 10, 7, 0, D("1.50"), _d("2020-01-01"), _ts("2020-01-01 01:00:00")),
    ], BRONZE["order_items"])
    s = S.refine_all({"customers": cust, "products": prod, "orders": orders,
                      "order_items": items})
    assert rows(s["orders"], "order_id") == [(10,)]
    assert rows(s["order_items"], "order_item_id") == [(100,)]


def test_dedup_runs_partial_top1_before_shuffle(spark, sf):
    plan = Chain(spark, sf).silver["order_items"]._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
