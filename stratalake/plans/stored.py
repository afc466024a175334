"""Registered queries that run the stored lake: land, ingest, refine, build, read back
(S1-S4, P1, U1, BR1, SV5, SC1, G4, PL1).

The batches are ingested out of order (1, 3, 2), each followed by a build, in
incremental mode; the layers must be those of a rebuild.  A lake is made once
for each session and input, below the shared folder that the session names in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import lookup_keys
from ..operators.reconcile import CHECKS, METRICS
from ..session import settings
from ..sources import fixtures as fx
from ..sources.lake import scratch_lake
from ..sources.schemas import EXTRACT_DATE, INGESTED_AT
from .. import TABLES
from .catalog import DATABASE, register
from .incremental import MONTH
from .pipeline import Pipeline

BACKFILL = (1, 3, 2)
#: A build runs some 150 joins, one day after another.  Each side that Spark broadcasts passes the driver, so with
#: the default of 10 MB a side they add up to gigabytes there; sides above this go by shuffle.
BUILD_CONF = {"spark.sql.autoBroadcastJoinThreshold": "512k", "spark.sql.adaptive.autoBroadcastJoinThreshold": "512k"}
_LAKES: dict[tuple[str, str], Pipeline] = {}


def backfilled(spark: SparkSession, sf_dir: str) -> Pipeline:
    """The pipeline over a lake that got batch 2 after batch 3."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        lake = scratch_lake(spark)
        pipe = Pipeline(spark, lake, mode="incremental")
        with settings(spark, BUILD_CONF):
            fx.land_extracts(spark, sf_dir, lake)
            for b in BACKFILL:
                pipe.run_day(fx.extract_date(b), fx.ingested_at(b))
        _LAKES[key] = pipe
    return _LAKES[key]


def stored_bronze_counts(spark, sf_dir) -> DataFrame:
    """S1, S3, P1, U1, BR1: rows per table and ingest, as landed, read raw and appended."""
    pipe = backfilled(spark, sf_dir)
    out = None
    for t in TABLES:
        part = pipe.bronze(t).groupBy(EXTRACT_DATE, INGESTED_AT).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(t).alias("table_name"), F.col(EXTRACT_DATE).alias("extract_date"),
            F.col(INGESTED_AT).alias("ingested_at"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


def backfill_dim_customer(spark, sf_dir) -> DataFrame:
    """SC1: the customer versions after a late batch was spliced in."""
    return backfilled(spark, sf_dir).gold("dim_customer")


def backfill_fact_sales(spark, sf_dir) -> DataFrame:
    """G4, PL1: the fact after the months that the late batch touched were built again."""
    return backfilled(spark, sf_dir).gold("fact_sales")


def backfill_silver_items(spark, sf_dir) -> DataFrame:
    """S2, S4, SV4: silver lines as stored."""
    return backfilled(spark, sf_dir).silver("order_items")


def backfill_refine_stats(spark, sf_dir) -> DataFrame:
    """A8 from the accounts: no bronze is read."""
    pipe = backfilled(spark, sf_dir)
    return pipe.state.refine_stats({t: pipe.silver(t) for t in ("customers", "products")})


def backfill_recon(spark, sf_dir) -> DataFrame:
    """R1-R6 from the accounts of the months."""
    out = backfilled(spark, sf_dir).reconcile(full=False)
    return out.select(*METRICS, *CHECKS, F.size("breaks").alias("n_breaks"), "ok")


def stored_inspect(spark, sf_dir) -> DataFrame:
    """Rows and versions of all stored layers, from the file footers."""
    return backfilled(spark, sf_dir).inspect()


def stored_batch_lines(spark, sf_dir) -> DataFrame:
    """J2 on the stored state: per month, the lines of the orders that the late batch sent, found by the batch's
    keys in the scan of the state (``lookup_keys``)."""
    pipe = backfilled(spark, sf_dir)
    sent = pipe.bronze("orders").where(F.col(EXTRACT_DATE) == F.lit(fx.extract_date(BACKFILL[-1])).cast("date"))
    found = lookup_keys(pipe.state.rows("order_items"), sent.select("order_id"), "order_id")
    return found.groupBy(F.col(MONTH).alias("month")).agg(
        F.count_distinct("order_id").alias("orders"), F.count(F.lit(1)).alias("lines"))


def stored_revenue_sql(spark, sf_dir) -> DataFrame:
    """Plain SQL over the staged views and marts of the stored lake."""
    register(backfilled(spark, sf_dir))
    return spark.sql(f"""
        SELECT o.status, count(*) AS lines, CAST(sum(f.quantity) AS BIGINT) AS units,
               CAST(sum(f.amount) AS DECIMAL(38,2)) AS revenue,
               count_if(c.customer_sk IS NULL) AS unresolved
        FROM {DATABASE}.fact_sales f
        JOIN {DATABASE}.stg_orders o ON o.order_id = f.order_id
        LEFT JOIN {DATABASE}.dim_customer c ON c.customer_sk = f.customer_sk
        GROUP BY o.status""")


QUERIES = {f.__name__: f for f in (stored_bronze_counts, backfill_dim_customer, backfill_fact_sales,
                                   backfill_silver_items, backfill_refine_stats, backfill_recon, stored_inspect,
                                   stored_batch_lines, stored_revenue_sql)}
