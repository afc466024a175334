"""Layers with faults put in by key arithmetic, to show that every contract,
model test and audit counts them (Q1-Q5, DT1-DT5, J6, J7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _where(key: str, mod: int, rem: int, value, otherwise: str) -> Column:
    """``value`` on the rows whose ``key`` leaves ``rem``, the column ``otherwise`` on the rest."""
    value = value if isinstance(value, Column) else F.lit(value)
    return F.when(F.col(key) % mod == rem, value).otherwise(F.col(otherwise))


def _twice(df: DataFrame, hit: Column) -> DataFrame:
    """Rows that meet ``hit`` occur twice."""
    copies = F.when(hit, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn("__copy", F.explode(copies)).drop("__copy")


def faulty_silver(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Null and repeated keys, codes outside their set, missing cities and customers, empty lines."""
    c, p, o, i = (silver[t] for t in ("customers", "products", "orders", "order_items"))
    return {
        "customers": _twice(c, F.col("customer_id") % 79 == 4).withColumns({
            "segment": _where("customer_id", 89, 3, "BOGUS", "segment"),
            "city": _where("customer_id", 83, 2, None, "city"),
            "customer_id": _where("customer_id", 97, 5, None, "customer_id")}),
        "products": _twice(p, F.col("product_id") % 67 == 3).withColumns({
            "category": _where("product_id", 71, 1, "XX", "category"),
            "product_id": _where("product_id", 73, 2, None, "product_id")}),
        "orders": _twice(o, F.col("order_id") % 47 == 4).withColumns({
            "status": _where("order_id", 61, 1, "LOST", "status"),
            "customer_id": _where("order_id", 59, 2, None, "customer_id"),
            "order_id": _where("order_id", 53, 3, None, "order_id")}),
        "order_items": _twice(i, F.col("order_item_id") % 37 == 3).withColumns({
            "quantity": _where("order_item_id", 43, 1, F.lit(0).cast("bigint"), "quantity"),
            "order_item_id": _where("order_item_id", 41, 2, None, "order_item_id")}),
    }


def faulty_gold(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Null, repeated and dangling keys, reopened and missing current versions, lost amounts and statuses."""
    c, p, d, f = (gold[t] for t in ("dim_customer", "dim_product", "dim_date", "fact_sales"))
    current = F.when(F.col("customer_id") % 23 == 4, True).when(F.col("customer_id") % 19 == 5, False)
    return {
        "dim_customer": _twice(c, F.col("customer_id") % 29 == 2).withColumns({
            "customer_sk": _where("customer_id", 31, 1, None, "customer_sk"),
            "is_current": current.otherwise(F.col("is_current")),
            "customer_id": _where("customer_id", 37, 3, None, "customer_id")}),
        "dim_product": _twice(p, F.col("product_sk") % 29 == 2).withColumns({
            "product_sk": _where("product_sk", 31, 1, None, "product_sk")}),
        "dim_date": _twice(d, F.col("day") == 2).withColumns({
            "date_day": F.when(F.col("day") != 1, F.col("date_day"))}),
        "fact_sales": _twice(f, F.col("order_item_id") % 37 == 3).withColumns({
            "customer_sk": F.when(F.col("order_item_id") % 31 == 4, None)
            .when(F.col("order_item_id") % 29 == 5, "nobody").otherwise(F.col("customer_sk")),
            "product_sk": _where("order_item_id", 23, 6, F.lit(-1).cast("bigint"), "product_sk"),
            "amount": _where("order_item_id", 19, 7, None, "amount"),
            "status": _where("order_item_id", 17, 8, "LOST", "status"),
            "order_item_id": _where("order_item_id", 41, 2, None, "order_item_id")}),
    }


def misdated_fact(fact: DataFrame) -> DataFrame:
    """Every eleventh line dated long before the version that it points at."""
    return fact.withColumn("date_day", F.when(F.col("order_item_id") % 11 == 0, F.date_sub("date_day", 4000))
                           .otherwise(F.col("date_day")))


def swapped_amounts(fact: DataFrame) -> DataFrame:
    """The first two lines of some orders with their amounts exchanged: no total changes."""
    line = F.col("order_item_id") % 10
    order = Window.partitionBy("order_id")
    of = lambda n: F.max(F.when(line == n, F.col("amount"))).over(order)
    other = F.when(line == 1, of(2)).when(line == 2, of(1))
    both = of(1).isNotNull() & of(2).isNotNull()
    return fact.withColumn("amount", F.when((F.col("order_id") % 97 == 5) & both, F.coalesce(other, F.col("amount")))
                           .otherwise(F.col("amount")))
