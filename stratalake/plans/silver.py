"""Silver: the current clean snapshot rebuilt from all of bronze (SV1-SV5, A8).

Each table keeps its newest row per natural key ("newest" = latest ingest,
not latest extract date), and filters apply to that newest row only.  The
referential cascade runs customers -> orders -> order_items, products ->
order_items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import TABLES
from ..functions.expressions import fill_unknown, normalize_code
from ..operators.dedup import latest_per_key
from ..operators.joins import keep_matching
from ..sources.schemas import INGESTED_AT, KEYS, SILVER

# Total orders for "newest row per key": ingest time first, then the extract's
# own change time where it has one, then every remaining column so ties are
# resolved the same way on every run (``-`` = descending).
ORDER = {
    "customers": ["-" + INGESTED_AT, "-updated_at", "name", "segment", "city"],
    "products": ["-" + INGESTED_AT, "name", "category", "unit_price"],
    "orders": ["-" + INGESTED_AT, "customer_id", "order_ts", "status"],
    "order_items": ["-" + INGESTED_AT, "product_id", "quantity", "unit_price"],
}


def clean_customers(bronze: DataFrame) -> DataFrame:
    """Row-level cleaning of customer rows (F1, F2); lineage is kept."""
    return bronze.withColumns({
        "segment": normalize_code("segment"),
        "city": fill_unknown("city"),
    })


def newest_rows(rows: DataFrame, table: str) -> DataFrame:
    """The newest row per key (pre-filter, lineage kept) of bronze rows or of
    a previous newest-row state plus new batches: the newest row over a union
    is the newest of the parts' newest rows, so the state merges exactly."""
    if table == "customers":
        rows = clean_customers(rows)
    return latest_per_key(rows, KEYS[table], ORDER[table])


def newest_rows_where(rows: DataFrame, table: str, some: str) -> DataFrame:
    """The newest row per key of all rows, marked ``__all``, and of those where the flag ``some`` is set, marked
    ``__some`` (one row may be both), without lineage, for orders and lines.

    Two minima of one grouping, partly taken before its shuffle: a key sent many times ships a row per task."""
    key, (stamp, *ties) = KEYS[table], ORDER[table]
    if stamp != "-" + INGESTED_AT or any(c.startswith("-") for c in ties):
        raise ValueError(f"{table} is not ordered by descending stamp, then ascending columns")
    ties += [c for c in SILVER[table].fieldNames() if c not in (key, *ties)]
    at = F.col(INGESTED_AT)
    # compared field by field, nulls first: the order of ORDER[table]
    row = F.struct(at.isNull().alias("__late"), (-F.unix_micros(at.cast("timestamp"))).alias("__at"), *ties)
    both = rows.groupBy(key).agg(F.min(row).alias("a"), F.min(F.when(F.col(some), row)).alias("s"))
    one = lambda r, all_, some_: F.struct(F.col(r).alias("r"), all_.alias("__all"), some_.alias("__some"))
    same, yes, no = F.col("a").eqNullSafe(F.col("s")), F.lit(True), F.lit(False)
    out = both.select(key, F.explode(F.array(one("a", yes, same), F.when(~same, one("s", no, yes)))).alias("o"))
    return out.where("o.r IS NOT NULL").select(key, *[F.col(f"o.r.{c}").alias(c) for c in ties], "o.__all", "o.__some")


def _silver_cols(df: DataFrame, table: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*SILVER[table].fieldNames(), *keep)


def finish_customers(newest: DataFrame) -> DataFrame:
    return _silver_cols(newest, "customers")


def finish_products(newest: DataFrame) -> DataFrame:
    return _silver_cols(newest, "products")


def finish_orders(newest: DataFrame, customers: DataFrame,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    kept = newest.where(F.col("status").isNotNull())
    return _silver_cols(keep_matching(kept, customers, "customer_id"), "orders", keep)


def finish_order_items(newest: DataFrame, orders: DataFrame | None,
                       products: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``orders=None`` leaves out the order check, for a caller that inner
    joins the lines to the silver orders on ``order_id`` anyway (the fact
    build): that join keeps exactly the lines the check would keep, so the
    check would only cost another shuffle of the line table."""
    kept = newest.where(F.col("quantity") > 0)
    if orders is not None:
        kept = keep_matching(kept, orders, "order_id")
    kept = keep_matching(kept, products, "product_id")
    return _silver_cols(kept, "order_items", keep)


def refine_customers(bronze: DataFrame) -> DataFrame:
    """SV1: newest row per customer; segment upper/trimmed, null city UNKNOWN."""
    return finish_customers(newest_rows(bronze, "customers"))


def refine_products(bronze: DataFrame) -> DataFrame:
    """SV2: newest row per product."""
    return finish_products(newest_rows(bronze, "products"))


def refine_orders(bronze: DataFrame, customers: DataFrame) -> DataFrame:
    """SV3: newest row per order, then drop null status and orphan customers."""
    return finish_orders(newest_rows(bronze, "orders"), customers)


def refine_order_items(bronze: DataFrame, orders: DataFrame,
                       products: DataFrame) -> DataFrame:
    """SV4: newest row per line, then drop non-positive quantities and lines
    whose order or product did not survive."""
    return finish_order_items(newest_rows(bronze, "order_items"), orders, products)


def refine_all(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """SV1-SV4 as lazy DataFrames, in the fixed dependency order."""
    customers = refine_customers(bronze["customers"])
    products = refine_products(bronze["products"])
    orders = refine_orders(bronze["orders"], customers)
    items = refine_order_items(bronze["order_items"], orders, products)
    return {"customers": customers, "products": products,
            "orders": orders, "order_items": items}


def as_of(bronze: DataFrame, ingested_before_or_at: str) -> DataFrame:
    """Bronze as it stood after the ingest at the given time (rebuild-as-of)."""
    return bronze.where(F.col(INGESTED_AT) <= F.lit(ingested_before_or_at).cast("timestamp_ntz"))


def refine_stats(bronze: dict[str, DataFrame], silver: dict[str, DataFrame]) -> DataFrame:
    """Per table bronze rows, kept rows and dropped = bronze - kept."""
    parts = []
    for t in TABLES:
        # one count per table and layer, each its own branch (run side by side)
        parts.append(bronze[t].agg(F.count(F.lit(1)).alias("bronze_rows"))
                     .select(F.lit(t).alias("table_name"), "bronze_rows",
                             F.lit(None).cast("bigint").alias("kept")))
        parts.append(silver[t].agg(F.count(F.lit(1)).alias("kept"))
                     .select(F.lit(t).alias("table_name"),
                             F.lit(None).cast("bigint").alias("bronze_rows"), "kept"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.groupBy("table_name").agg(F.max("bronze_rows").alias("bronze_rows"),
                                        F.max("kept").alias("kept"))
    return out.withColumn("dropped", F.col("bronze_rows") - F.col("kept"))


FINISH = {"customers": finish_customers, "products": finish_products,
          "orders": finish_orders, "order_items": finish_order_items}

__all__ = ["ORDER", "FINISH", "newest_rows", "refine_all", "refine_customers",
           "refine_products", "refine_orders", "refine_order_items", "refine_stats", "as_of",
           "clean_customers"]
