"""The incremental mode: what a batch changes, and the months it touches (SC1, PL1, G4, A8).

Orders, lines, silver and the fact are laid out by the month of the order, and
a build replaces the touched months only.  An ingested batch, whatever its
stamp, is first reduced to its changes:

- orders and lines whose newest row is now another one, with the month they
  leave and the month they enter (lines follow their order);
- customers whose version chain is another one, and since when;
- products that were not there before, which let trimmed lines in.

Each of these selects the months to build again: for customers those in which
they have orders from that time on.  Months are marked before any state is
replaced, and every state takes a batch sent again without a change, so a run
that broke off is repeated from its ingest.  The build settles the marks last.

Per month, the silver and fact tables are counted and summed into small account
tables, each month's row replaced with the month.  Kept and dropped rows and
the reconciliation add them up, so a day reads no bronze but its own batch and
no month that it did not touch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import TABLES
from ..functions.expressions import exact_total
from ..operators.dedup import _order
from ..operators.joins import lookup_keys
from ..sources.bucketed import BUCKETS, PARTS, BucketedState
from ..sources.lake import (CODEC, Lake, current_folder, current_version, delete, list_names, next_version, prune_versions, read_version,
                            write_version)
from ..sources.schemas import BRONZE, EXTRACT_DATE, INGESTED_AT, KEYS, STAGED_TYPES
from . import gold as G
from . import silver as S

MONTH = "_m"
#: Month of an order without a readable time, and of lines without an order.
NO_MONTH = "none"
DIMENSIONS = ("customers", "products")
#: Partition of the landed counts: one for each ingest.
BATCH = "_b"
LANDED = T.StructType([T.StructField(EXTRACT_DATE, T.DateType()), T.StructField(INGESTED_AT, T.TimestampNTZType()),
                       T.StructField("rows", T.LongType()), T.StructField("table_name", T.StringType())])
_MONEY = T.DecimalType(38, 2)
SILVER_ACCOUNTS = T.StructType([T.StructField("orders", T.LongType()), T.StructField("items", T.LongType()),
                                T.StructField("revenue", _MONEY), T.StructField(MONTH, T.StringType())])
FACT_ACCOUNTS = T.StructType([T.StructField("rows", T.LongType()), T.StructField("revenue", _MONEY),
                              T.StructField("unresolved", T.LongType()), T.StructField(MONTH, T.StringType())])
CHAIN = T.StructType([T.StructField(c, T.TimestampNTZType() if STAGED_TYPES["customers"][c] == "timestamp_ntz" else
                                    T.LongType() if STAGED_TYPES["customers"][c] == "bigint" else T.StringType())
                      for c in G.CUSTOMER_ATTRS] + [T.StructField(INGESTED_AT, T.TimestampNTZType())])


def month_of(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, "yyyy-MM"), F.lit(NO_MONTH))


def with_month(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(MONTH, T.StringType())])


def months_in(df: DataFrame, *columns: str) -> set[str]:
    """The distinct months in these columns (as many as there are months, whatever the rows)."""
    found = df.select(F.explode(F.array(*columns)).alias("m")).where("m IS NOT NULL").distinct().collect()
    return {r["m"] for r in found}


def concurrently(*steps: Callable[[], object]) -> list:
    """Submit independent Spark jobs together (e.g. the writes of unrelated
    tables), so small tables do not queue behind large ones."""
    if len(steps) == 1:
        return [steps[0]()]
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        futures = [pool.submit(s) for s in steps]
        return [f.result() for f in futures]


class IncrementalState:
    """``parts`` and ``buckets``: layout of the newest rows of customers and products (``sources.bucketed``)."""

    def __init__(self, spark: SparkSession, lake: Lake, parts: int = PARTS, buckets: int = BUCKETS):
        self.spark, self.lake, self.parts, self.buckets = spark, lake, parts, buckets

    # ---- tables --------------------------------------------------------------
    def dimension_path(self, table: str) -> str:
        return self.lake.state_path(f"newest_{table}_{self.parts}x{self.buckets}")

    def dimension(self, table: str) -> BucketedState:
        return BucketedState(self.spark, self.dimension_path(table), BRONZE[table], KEYS[table], S.ORDER[table],
                             self.parts, self.buckets)

    def _versioned(self, path: str, schema: T.StructType) -> DataFrame | None:
        v = current_version(self.spark, path)
        return None if v is None else read_version(self.spark, path, v, schema)

    def _commit_version(self, df: DataFrame, path: str) -> None:
        prev = current_version(self.spark, path)
        write_version(df, path, next_version(prev))
        if prev is not None:
            prune_versions(self.spark, path, keep_from=prev)

    def _empty(self, schema) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    @property
    def chain_path(self) -> str:
        return self.lake.state_path("customer_snapshot")

    def chain(self) -> DataFrame | None:
        """The version chains of all customers (see ``operators.scd2``)."""
        return self._versioned(self.chain_path, CHAIN)

    def monthly(self, path: str, schema: T.StructType, months=None) -> DataFrame:
        """A table laid out by month, or some months of it; empty where there is none."""
        if not self.lake.partitioned(self.spark, path, MONTH):
            return self._empty(with_month(schema))
        df = self.spark.read.schema(with_month(schema)).parquet(current_folder(self.spark, path))
        return df if months is None else df.where(F.col(MONTH).isin(sorted(months)))

    def rows_path(self, table: str) -> str:
        return self.lake.state_path(f"monthly_{table}")

    def rows(self, table: str, months=None) -> DataFrame:
        """Newest rows of orders or lines with their month."""
        return self.monthly(self.rows_path(table), BRONZE[table], months)

    def newest(self, table: str) -> DataFrame:
        """The newest row per key of everything ingested."""
        if table in DIMENSIONS:
            if not self.dimension(table).exists():
                raise FileNotFoundError(f"no newest-row state under {self.dimension_path(table)}")
            return self.dimension(table).rows()
        if not self.lake.partitioned(self.spark, self.rows_path(table), MONTH):
            raise FileNotFoundError(f"no newest-row state under {self.rows_path(table)}")
        return self.rows(table).drop(MONTH)

    def started(self) -> bool:
        """False where a part of the state is missing; it then starts from all of bronze."""
        return self.chain() is not None and all(self.dimension(t).exists() for t in DIMENSIONS)

    # ---- changes of a batch -----------------------------------------------------
    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        """Changes, written once: several steps read them."""
        path = self.lake.state_path(f"changes/{name}")
        df.write.mode("overwrite").option("compression", CODEC).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _changed(self, table: str, top: DataFrame) -> DataFrame:
        """The rows of ``top`` (one per key, with their month, stored) that are the newest now, with the month they left.

        The key column alone finds the months that hold these keys; whole rows are read of those months only."""
        key, cols = KEYS[table], BRONZE[table].fieldNames()
        keys = top.select(key)
        holding = months_in(lookup_keys(self.rows(table), keys, key), MONTH)
        if not holding:   # new keys only: nothing to compare
            return top.select(*cols, MONTH, F.lit(None).cast("string").alias("old_month"))
        old = lookup_keys(self.rows(table, holding), keys, key)
        both = (old.select(*cols, MONTH).withColumn("__new", F.lit(0))
                .unionByName(top.select(*cols, MONTH).withColumn("__new", F.lit(1))))
        by_key = Window.partitionBy(key)
        # an equal row is no change
        nth = F.row_number().over(by_key.orderBy(*[_order(c) for c in S.ORDER[table]], "__new"))
        left = F.max(F.when(F.col("__new") == 0, F.col(MONTH))).over(by_key)
        return (both.withColumn("__nth", nth).withColumn("old_month", left)
                .where((F.col("__nth") == 1) & (F.col("__new") == 1)).drop("__nth", "__new"))

    def _changed_orders(self, top: DataFrame) -> DataFrame:
        return self._changed("orders", top.withColumn(MONTH, month_of(F.try_to_timestamp("order_ts"))))

    def _changed_lines(self, top: DataFrame, orders: DataFrame) -> DataFrame:
        """Lines of the batch that are the newest now, and lines of orders that entered another month; stored."""
        placed = lookup_keys(self.rows("orders").select("order_id", MONTH), top, "order_id")
        placed = placed.join(orders.select("order_id"), "order_id", "left_anti")
        placed = placed.unionByName(orders.select("order_id", MONTH))
        cols = BRONZE["order_items"].fieldNames()
        top = top.join(placed, "order_id", "left").select(
            *cols, F.coalesce(MONTH, F.lit(NO_MONTH)).alias(MONTH))
        changed = self._kept(self._changed("order_items", top), "batch_lines")
        moves = orders.select("order_id", F.col(MONTH).alias("__to"),
                              F.coalesce("old_month", F.lit(NO_MONTH)).alias("__from")).where("__to != __from")
        left = self.rows("order_items", months_in(moves, "__from"))
        if left.isEmpty():   # no line lies in a month that an order left
            return changed.select(*cols, MONTH, "old_month")
        followers = (left.join(moves, "order_id")
                     .where(F.col(MONTH) == F.col("__from"))
                     .select(*cols, F.col("__to").alias(MONTH), F.col("__from").alias("old_month"))
                     .join(changed.select("order_item_id"), "order_item_id", "left_anti"))
        return self._kept(changed.select(*cols, MONTH, "old_month").unionByName(
            followers.select(*cols, MONTH, "old_month")), "order_items")

    def _months_of_customers(self, changes: DataFrame) -> set[str]:
        """Months in which customers have orders since their versions changed."""
        per = changes.groupBy("customer_id").agg(
            F.when(F.count_if(F.col("since").isNull()) > 0, F.lit("")).otherwise(
                F.date_format(F.min("since"), "yyyy-MM")).alias("__since"))
        least = per.agg(F.min("__since")).first()[0]
        if least is None:
            return set()
        behind = self.rows("orders").where((F.col(MONTH) >= least) | (F.col(MONTH) == NO_MONTH))
        met = behind.select("customer_id", MONTH).join(per, "customer_id").where(
            (F.col(MONTH) >= F.col("__since")) | (F.col(MONTH) == NO_MONTH))
        return months_in(met, MONTH)

    def _months_of_products(self, new: DataFrame) -> set[str]:
        if new.isEmpty():
            return set()
        return months_in(lookup_keys(self.rows("order_items").select("product_id", MONTH), new, "product_id"), MONTH)

    # ---- taking a batch ------------------------------------------------------------
    def _put(self, table: str, changed: DataFrame) -> None:
        """Replace the months that changed rows leave or enter, by one write."""
        touched = months_in(changed, MONTH, "old_month")
        if not touched:
            return
        key = KEYS[table]
        rest = self.rows(table, touched).join(changed.select(key), key, "left_anti")
        cols = [*BRONZE[table].fieldNames(), MONTH]
        self.lake.overwrite_partitions(rest.select(*cols).unionByName(changed.select(*cols)),
                                       self.rows_path(table), MONTH, touched, fmt="parquet")

    def advance(self, batch: dict[str, DataFrame]) -> None:
        """Take bronze rows of any stamps into the state; rows sent again change nothing."""
        top = {t: S.newest_rows(batch[t], t) for t in TABLES}
        # written once: their keys are looked up in the state, before its shuffle (``lookup_keys``)
        top |= dict(zip(("orders", "order_items"), concurrently(
            *[lambda t=t: self._kept(top[t], f"newest_{t}") for t in ("orders", "order_items")])))
        chain = self.chain()
        chain = chain if chain is not None else self._empty(CHAIN)

        def customer_changes() -> tuple[DataFrame, set[str]]:
            found = self._kept(G.customer_changes(chain, G.staged_customers(batch["customers"])), "customers")
            return found, self._months_of_customers(found)

        def new_products() -> set[str]:
            new = top["products"].select("product_id")
            if self.dimension("products").exists():
                new = new.join(self.newest("products"), "product_id", "left_anti")
            return self._months_of_products(self._kept(new, "products"))

        def changed_rows() -> tuple[DataFrame, DataFrame, set[str]]:
            orders = self._kept(self._changed_orders(top["orders"]), "orders")
            lines = self._changed_lines(top["order_items"], orders)
            return orders, lines, months_in(orders, MONTH, "old_month") | months_in(lines, MONTH, "old_month")

        (customers, since), let_in, (orders, lines, moved) = concurrently(customer_changes, new_products, changed_rows)
        self.mark(since | let_in | moved)

        # from here on the state is replaced
        def splice() -> None:
            if not customers.isEmpty() or self.chain() is None:
                self._commit_version(G.customer_chain(chain, customers), self.chain_path)

        def put_rows() -> None:
            self._put("order_items", lines)   # lines before orders, whose months place them
            self._put("orders", orders)

        concurrently(*[lambda t=t: self.dimension(t).merge(top[t]) for t in DIMENSIONS], splice, put_rows,
                     lambda: self._count_landed(batch))

    def _count_landed(self, batch: dict[str, DataFrame]) -> None:
        """Rows in bronze of each ingest in ``batch``; counted again, they replace the old count."""
        parts = [df.groupBy(EXTRACT_DATE, INGESTED_AT).agg(F.count(F.lit(1)).alias("rows"))
                 .withColumn("table_name", F.lit(t)) for t, df in batch.items()]
        rows = reduce(lambda a, b: a.unionByName(b), parts).withColumn(
            BATCH, F.date_format(INGESTED_AT, "yyyyMMddHHmmssSSSSSS"))
        rows = self._kept(rows, "landed")
        batches = {r[0] for r in rows.select(BATCH).distinct().collect()}
        self.lake.overwrite_partitions(rows.coalesce(1), self.lake.state_path("landed"), BATCH, batches, fmt="parquet")

    # ---- months to build ---------------------------------------------------------
    def mark(self, months: set[str], layer: str = "silver") -> None:
        """Note that ``layer`` has to build these months again."""
        if months:
            self.spark.createDataFrame([(m,) for m in sorted(months)], f"{MONTH} string").coalesce(1).write.parquet(
                self.lake.state_path(f"marks_{layer}/{uuid.uuid4().hex}"))

    def marked(self, layer: str) -> tuple[list[str], set[str]]:
        """The marks of a layer that are not settled yet, and their months."""
        root = self.lake.state_path(f"marks_{layer}")
        marks = [f"{root}/{m}" for m in list_names(self.spark, root)]
        if not marks:
            return [], set()
        return marks, months_in(self.spark.read.schema(f"{MONTH} string").parquet(*marks), MONTH)

    def settle(self, marks: list[str]) -> None:
        for m in marks:
            delete(self.spark, m)

    def all_months(self) -> set[str]:
        return months_in(self.rows("orders"), MONTH) | months_in(self.rows("order_items"), MONTH)

    # ---- accounts ------------------------------------------------------------------
    def _account(self, name: str, schema: T.StructType, sums: DataFrame, months: set[str]) -> None:
        """Replace the account rows of ``months``; a month without rows counts nothing."""
        path = self.lake.state_path(name)
        rows = sums.select(*schema.fieldNames())
        if self.lake.exists(self.spark, path):
            rows = self._accounts(name, schema).where(~F.col(MONTH).isin(sorted(months))).unionByName(rows)
        # one row per month
        self.lake.overwrite(rows.coalesce(1), path, fmt="parquet")

    def _accounts(self, name: str, schema: T.StructType) -> DataFrame:
        path = self.lake.state_path(name)
        if not self.lake.exists(self.spark, path):
            return self._empty(schema)
        return self.lake.read(self.spark, path, schema, fmt="parquet")

    def account_silver(self, orders: DataFrame, items: DataFrame, months: set[str]) -> None:
        """``orders`` and ``items``: silver rows of these months, with their month."""
        counted = orders.groupBy(MONTH).agg(F.count(F.lit(1)).alias("orders"))
        summed = items.groupBy(MONTH).agg(F.count(F.lit(1)).alias("items"),
                                          exact_total(F.col("quantity") * F.col("unit_price")).alias("revenue"))
        both = counted.join(summed, MONTH, "left").select(
            "orders", F.coalesce("items", F.lit(0)).alias("items"),
            F.coalesce("revenue", F.lit(0)).cast(_MONEY).alias("revenue"), MONTH)
        self._account("accounts_silver", SILVER_ACCOUNTS, both, months)

    def account_fact(self, fact: DataFrame, months: set[str]) -> None:
        self._account("accounts_fact", FACT_ACCOUNTS, fact.groupBy(MONTH).agg(
            F.count(F.lit(1)).alias("rows"), exact_total("amount").alias("revenue"),
            F.count_if(F.col("customer_sk").isNull()).alias("unresolved")), months)

    def silver_accounts(self) -> DataFrame:
        return self._accounts("accounts_silver", SILVER_ACCOUNTS)

    def fact_accounts(self) -> DataFrame:
        return self._accounts("accounts_fact", FACT_ACCOUNTS)

    def landed(self) -> DataFrame:
        return self.spark.read.schema(LANDED).parquet(self.lake.state_path("landed"))

    def refine_stats(self, silver: dict[str, DataFrame]) -> DataFrame:
        """A8 without reading bronze: landed rows of every ingest, kept rows of every month."""
        landed = self.landed().groupBy("table_name").agg(F.sum("rows").alias("bronze_rows"))
        kept = self.silver_accounts().agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("orders", "items")])
        parts = [silver[t].agg(F.count(F.lit(1)).alias("kept")).select(F.lit(t).alias("table_name"), "kept")
                 for t in DIMENSIONS]
        parts += [kept.select(F.lit(t).alias("table_name"), F.col(c).alias("kept"))
                  for t, c in (("orders", "orders"), ("order_items", "items"))]
        return reduce(lambda a, b: a.unionByName(b), parts).join(landed, "table_name", "left").select(
            "table_name", F.coalesce("bronze_rows", F.lit(0)).alias("bronze_rows"), "kept",
            (F.coalesce("bronze_rows", F.lit(0)) - F.col("kept")).alias("dropped"))
