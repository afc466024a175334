"""Gold: staging casts, the SCD2 customer snapshot and the star schema
(P3, P4, SC1/SC2, G1-G4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import line_amount, to_day
from ..operators.joins import pit_join
from ..operators.scd2 import scd2_decisive, scd2_merge, scd2_rebuild, scd2_splice, scd2_versions
from ..operators.spine import calendar_attributes, date_spine
from ..sources.schemas import INGESTED_AT, STAGED_TYPES
from .silver import ORDER, clean_customers

CUSTOMER_ATTRS = ("customer_id", "name", "segment", "city", "updated_at")


def stage(df: DataFrame, table: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Conforming casts of a silver table (ANSI casts: overflow raises)."""
    types = STAGED_TYPES[table]
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()], *keep)


def stage_all(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {t: stage(df, t) for t, df in silver.items()}


# ---- SCD2 snapshot ------------------------------------------------------------

def customer_snapshot_rebuild(bronze_customers: DataFrame) -> DataFrame:
    """SC2 over the whole bronze history of customers.

    Rows are cleaned and staged exactly like the silver refine, then every
    ingest batch is one snapshot run."""
    staged = stage(clean_customers(bronze_customers), "customers", keep=(INGESTED_AT,))
    tie = [c for c in ORDER["customers"][2:]]
    return scd2_rebuild(staged, key="customer_id", updated_at="updated_at",
                        batch=INGESTED_AT, attrs=CUSTOMER_ATTRS, tie_break=tie)


def customer_snapshot_merge(history: DataFrame | None,
                            silver_customers: DataFrame) -> DataFrame:
    """SC1: one snapshot run of the current staged customers against the
    stored history (None on the first run)."""
    staged = stage(silver_customers, "customers").select(*CUSTOMER_ATTRS)
    return scd2_merge(history, staged, key="customer_id", updated_at="updated_at")


_CHAIN = dict(key="customer_id", updated_at="updated_at", batch=INGESTED_AT, attrs=CUSTOMER_ATTRS)


def staged_customers(bronze_customers: DataFrame) -> DataFrame:
    """Bronze customer rows cleaned and staged as the refine does, with their ingest stamp."""
    return stage(clean_customers(bronze_customers), "customers", keep=(INGESTED_AT,))


def customer_changes(chain: DataFrame, batch: DataFrame) -> DataFrame:
    """The staged rows of a batch that change a customer's versions, with ``since``."""
    return scd2_decisive(chain, batch, tie_break=ORDER["customers"][2:], **_CHAIN)


def customer_chain(chain: DataFrame, changes: DataFrame) -> DataFrame:
    """SC1 for a batch of any stamp: the chain state with the changes in place."""
    return scd2_splice(chain, changes, tie_break=ORDER["customers"][2:], **_CHAIN)


def customer_snapshot(chain: DataFrame) -> DataFrame:
    """The versions that the stored chain stands for."""
    return scd2_versions(chain, **_CHAIN)


# ---- marts ----------------------------------------------------------------------

def dim_customer(snapshot: DataFrame) -> DataFrame:
    """G1: one row per customer version; the version hash is the surrogate key."""
    return snapshot.select(
        F.col("scd_id").alias("customer_sk"),
        "customer_id", "name", "segment", "city",
        "valid_from", "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def dim_product(stg_products: DataFrame) -> DataFrame:
    """Type-1 product dimension; the natural key is the surrogate key."""
    return stg_products.select(
        F.col("product_id").alias("product_sk"), "product_id", "name", "category", "unit_price")


def dim_date(stg_orders: DataFrame) -> DataFrame:
    """Dense day spine from the first to the last order day."""
    return calendar_attributes(date_spine(stg_orders, "order_ts"))


def fact_sales(stg_items: DataFrame, stg_orders: DataFrame, dim_cust: DataFrame,
               open_upper: bool = True) -> DataFrame:
    """Order-line grain; the customer key is the version valid at order time.

    The version depends only on the order's ``customer_id`` and ``order_ts``,
    so it is resolved once per ORDER (the point-in-time join shuffles orders
    by customer, not the much larger line table); lines then meet their
    resolved order on ``order_id``.  Same rows as resolving per line,
    including fan-out if versions ever overlapped.

    ``open_upper=False`` reproduces the classic bug of comparing against a
    null ``valid_to`` (used only to prove reconciliation catches it)."""
    orders = stg_orders.select("order_id", "customer_id", "order_ts", "status")
    resolved = pit_join(orders, dim_cust, key="customer_id", ts="order_ts",
                        version_cols=["customer_sk"], open_upper=open_upper)
    lines = stg_items.join(resolved.drop("customer_id"), "order_id")
    return lines.select(
        "order_item_id", "order_id", "customer_sk",
        F.col("product_id").alias("product_sk"),
        to_day("order_ts").alias("date_day"),
        "quantity", "unit_price",
        line_amount("quantity", "unit_price").alias("amount"),
        "status",
    )


def build_gold(silver: dict[str, DataFrame], bronze_customers: DataFrame) -> dict[str, DataFrame]:
    """All gold tables as lazy DataFrames (snapshot rebuilt from bronze)."""
    stg = stage_all(silver)
    snap = customer_snapshot_rebuild(bronze_customers)
    dc = dim_customer(snap)
    return {
        "customer_snapshot": snap,
        "dim_customer": dc,
        "dim_product": dim_product(stg["products"]),
        "dim_date": dim_date(stg["orders"]),
        "fact_sales": fact_sales(stg["order_items"], stg["orders"], dc),
    }
