"""Daily retail extracts derived from the supplied TPC-H-style tables.

The supplied tables are clean, so the mess the pipeline must handle (messy
segments, missing cities, whole-row duplicates, orphan customers, null
statuses, zero quantities, changed customers, late-arriving customers) is
injected by key arithmetic.  Every rule is a column expression, so one scan of
each source produces all batches: the batch number is either a literal (one
extract) or a generated column (the whole history), and both paths share the
same expressions.

Batches: customers and products arrive as FULL extracts every batch, orders
and order lines as INCREMENTAL extracts split by order date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import EXTRACT_DATE, INGESTED_AT, RAW
from .tables import read_source

# ---- fixed values of the fixture --------------------------------------------
# (batch number, extract date); the batch is ingested at 01:00 of that day.
BATCHES = ((1, "1995-01-01"), (2, "1997-01-01"), (3, "1999-01-01"))
INGEST_TIME = "01:00:00"
SEGMENT_SPELLINGS = (" smb", "Mid ", " ENT ")          # by (key + changes) % 3
CATEGORIES = ("HW", "SW", "ACC")                       # by product key % 3
OPEN_STATUS = ("CANCELLED", "REFUNDED", "NEW")         # by order key % 3
STATUS_MAP = {"P": "PAID", "F": "SHIPPED"}
NEW_CUSTOMER_MOD, NEW_CUSTOMER_REM = 50, 49            # absent from batch 1
DUP_CUSTOMER_MOD, DUP_CUSTOMER_REM = 50, 10            # sent twice per extract
NULL_STATUS_REM, ORPHAN_REM = 17, 33                   # order key % 100
ZERO_QTY_MOD = 100                                     # part key % 100 == 0
# -----------------------------------------------------------------------------

BATCH = "_batch"
VARIANTS = ("clean", "early_new_orders")
#: On rows of orders and lines of the other variant: whether the clean one has them too.
IN_CLEAN = "_in_clean"


def batch_numbers(upto: int | None = None) -> list[int]:
    return [b for b, _ in BATCHES if upto is None or b <= upto]


def extract_date(batch: int) -> str:
    return dict(BATCHES)[batch]


def ingested_at(batch: int) -> str:
    return f"{extract_date(batch)} {INGEST_TIME}"


def _with_batch(df: DataFrame, batches: Sequence[int]) -> DataFrame:
    """One copy of every row per batch, without a join (a generator)."""
    if len(batches) == 1:
        return df.withColumn(BATCH, F.lit(batches[0]))
    return df.withColumn(BATCH, F.explode(F.array(*[F.lit(b) for b in batches])))


def _lineage(batch: Column) -> list[Column]:
    dates = F.array(*[F.lit(d) for _, d in BATCHES])
    stamps = F.array(*[F.lit(f"{d} {INGEST_TIME}") for _, d in BATCHES])
    return [F.to_date(F.element_at(dates, batch)).alias(EXTRACT_DATE),
            F.element_at(stamps, batch).cast("timestamp_ntz").alias(INGESTED_AT)]


def _pick(values: Sequence[str], index: Column) -> Column:
    """values[index] for a 0-based integer index column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _order_batch(order_date: Column) -> Column:
    """Orders (and their lines) belong to the batch before whose date they fall."""
    expr = None
    for (b, _), (_, nxt) in zip(BATCHES, BATCHES[1:]):
        cond = order_date < F.lit(nxt).cast("timestamp_ntz")
        expr = F.when(cond, F.lit(b)) if expr is None else expr.when(cond, F.lit(b))
    return expr.otherwise(F.lit(BATCHES[-1][0]))


def _order_date_range(batches: Sequence[int]) -> Column | None:
    """Scan-level predicate (pushed to parquet) selecting the given order batches."""
    lo, hi = min(batches), max(batches)
    nxt = dict((b, d) for b, d in zip([b for b, _ in BATCHES], [d for _, d in BATCHES[1:]]))
    preds = []
    if lo > BATCHES[0][0]:
        preds.append(F.col("o_orderdate") >= F.lit(nxt[lo - 1]).cast("timestamp_ntz"))
    if hi < BATCHES[-1][0]:
        preds.append(F.col("o_orderdate") < F.lit(nxt[hi]).cast("timestamp_ntz"))
    out = None
    for p in preds:
        out = p if out is None else out & p
    return out


def _customers(spark: SparkSession, sf_dir: str, batches: Sequence[int]) -> DataFrame:
    c = read_source(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey"])
    n = read_source(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    key, b = F.col("c_custkey"), F.col(BATCH)
    rows = _with_batch(c.join(n, c.c_nationkey == n.n_nationkey), batches)
    rows = rows.where(~((b == 1) & (key % NEW_CUSTOMER_MOD == NEW_CUSTOMER_REM)))
    copies = F.when(key % DUP_CUSTOMER_MOD == DUP_CUSTOMER_REM, 2).otherwise(1)
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    changes = (F.when((b >= 2) & (key % 10 == 3), 1).otherwise(0)
               + F.when((b >= 3) & (key % 10).isin(3, 6), 1).otherwise(0))
    updated = (F.when((b >= 3) & (key % 10).isin(3, 6), F.lit("1999-01-01"))
               .when(((b >= 2) & (key % 10 == 3))
                     | (key % NEW_CUSTOMER_MOD == NEW_CUSTOMER_REM), F.lit("1997-01-01"))
               .otherwise(F.lit("1995-01-01")))
    return rows.select(
        key.alias("customer_id"),
        F.col("c_name").alias("name"),
        _pick(SEGMENT_SPELLINGS, (key + changes) % 3).alias("segment"),
        F.when((key + b) % 20 == 7, F.lit(None).cast("string"))
         .otherwise(F.col("n_name")).alias("city"),
        F.concat(updated, F.lit(" 00:00:00")).alias("updated_at"),
        *_lineage(b),
    )


def _products(spark: SparkSession, sf_dir: str, batches: Sequence[int]) -> DataFrame:
    p = read_source(spark, sf_dir, "part", ["p_partkey", "p_name", "p_retailprice"])
    rows = _with_batch(p, batches)
    return rows.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        _pick(CATEGORIES, F.col("p_partkey") % 3).alias("category"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("unit_price"),
        *_lineage(F.col(BATCH)),
    )


def _in_clean() -> Column:
    """Whether the clean variant has an order: not where its customer is new and it came before the customer."""
    first_new = F.lit(extract_date(2)).cast("timestamp_ntz")
    return ~((F.col("o_custkey") % NEW_CUSTOMER_MOD == NEW_CUSTOMER_REM) & (F.col("o_orderdate") < first_new))


def _orders_keyed(spark: SparkSession, sf_dir: str, batches: Sequence[int],
                  variant: str) -> DataFrame:
    o = read_source(spark, sf_dir, "orders",
                    ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    rng = _order_date_range(batches)
    if rng is not None:
        o = o.where(rng)
    if variant == "clean":
        o = o.where(_in_clean())
    elif variant != "early_new_orders":
        raise ValueError(f"unknown fixture variant {variant!r}")
    return o.withColumn(IN_CLEAN, F.coalesce(_in_clean(), F.lit(False))).withColumn(
        BATCH, _order_batch(F.col("o_orderdate")))


def _orders(spark, sf_dir, batches, variant, keep: Sequence[str] = ()) -> DataFrame:
    o = _orders_keyed(spark, sf_dir, batches, variant)
    k = F.col("o_orderkey")
    status = (F.when(k % 100 == NULL_STATUS_REM, F.lit(None).cast("string"))
              .when(F.col("o_orderstatus") == "P", F.lit(STATUS_MAP["P"]))
              .when(F.col("o_orderstatus") == "F", F.lit(STATUS_MAP["F"]))
              .otherwise(_pick(OPEN_STATUS, k % 3)))
    return o.select(
        k.alias("order_id"),
        F.when(k % 100 == ORPHAN_REM, -1 - F.col("o_custkey"))
         .otherwise(F.col("o_custkey")).alias("customer_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_ts"),
        status.alias("status"),
        *_lineage(F.col(BATCH)),
        *keep,
    )


def _order_items(spark, sf_dir, batches, variant, keep: Sequence[str] = ()) -> DataFrame:
    o = _orders_keyed(spark, sf_dir, batches, variant).select(
        F.col("o_orderkey"), F.col(BATCH), *keep)
    li = read_source(spark, sf_dir, "lineitem",
                     ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                      "l_extendedprice"])
    rows = li.join(o, li.l_orderkey == o.o_orderkey)
    return rows.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.when(F.col("l_partkey") % ZERO_QTY_MOD == 0, F.lit(0).cast("bigint"))
         .otherwise(F.col("l_quantity").cast("int").cast("bigint")).alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
        *_lineage(F.col(BATCH)),
        *keep,
    )


_BUILDERS = {"customers": _customers, "products": _products,
             "orders": _orders, "order_items": _order_items}


def _build(spark, sf_dir, table, batches, variant):
    fn = _BUILDERS[table]
    if table in ("orders", "order_items"):
        return fn(spark, sf_dir, batches, variant)
    return fn(spark, sf_dir, batches)


def raw_extract(spark: SparkSession, sf_dir: str, table: str, batch: int,
                variant: str = "clean") -> DataFrame:
    """One day's extract of one table, exactly as it lands (raw columns only)."""
    df = _build(spark, sf_dir, table, [batch], variant)
    return df.select(*RAW[table].fieldNames())


def bronze_history(spark: SparkSession, sf_dir: str, table: str,
                   upto: int | None = None, variant: str = "clean") -> DataFrame:
    """Every extract of ``table`` up to batch ``upto`` with its lineage columns:
    what bronze holds after ingesting batches 1..upto once each, in order."""
    return _build(spark, sf_dir, table, batch_numbers(upto), variant)


def bronze_of_both(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Every extract of orders or lines of the variant with early orders, and which rows the clean one has
    too (``IN_CLEAN``): both variants by one scan and join of the sources."""
    fn = {"orders": _orders, "order_items": _order_items}[table]
    return fn(spark, sf_dir, batch_numbers(), "early_new_orders", (IN_CLEAN,))


def land_extracts(spark: SparkSession, sf_dir: str, lake, variant: str = "clean",
                  upto: int | None = None) -> None:
    """Land every day's extract of every table in the lake's landing zone.

    One scan per source table writes all days at once, partitioned by the
    extract date, so the daily ingest reads exactly its own folder.  The four
    tables are independent, so their writes run as concurrent jobs."""
    from concurrent.futures import ThreadPoolExecutor

    from .lake import CODEC, RAW_PARTITION

    def land(t: str) -> None:
        df = bronze_history(spark, sf_dir, t, upto, variant)
        out = df.select(*RAW[t].fieldNames(),
                        F.col(EXTRACT_DATE).cast("string").alias(RAW_PARTITION))
        (out.write.mode("overwrite").option("compression", CODEC).partitionBy(RAW_PARTITION)
            .parquet(lake.raw_root(t)))

    with ThreadPoolExecutor(max_workers=len(RAW)) as pool:
        for f in [pool.submit(land, t) for t in RAW]:
            f.result()
