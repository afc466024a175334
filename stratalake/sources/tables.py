"""Readers for the supplied source tables (one parquet file or folder each).

Only the columns a caller names are read, so the parquet scan's ``ReadSchema``
stays narrow; filters placed on the result are pushed into the scan (also
through the spreading repartition below).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ---- fixed values ---------------------------------------------------------------
# A source between these sizes, stored in fewer files than the session has
# cores, is spread round-robin over the cores right after the scan.
SPREAD_MIN_BYTES = 1 << 20
SPREAD_MAX_BYTES = 1 << 25
# ---------------------------------------------------------------------------------


def source_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def size_in_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan (from the file index; reads no data)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - e.g. a Connect session: no estimate, no spreading
        return None


def spread_small(spark: SparkSession, df: DataFrame, min_bytes: int = SPREAD_MIN_BYTES,
                 max_bytes: int = SPREAD_MAX_BYTES) -> DataFrame:
    """Spread a small table that sits in few files over all cores.

    A parquet row group is the smallest unit a scan can split, so a file
    written as one row group is read by ONE task, and every narrow step after
    the scan (filters, broadcast joins, partial aggregates, map-side top-1)
    runs on one core.  Such a table gets one round-robin shuffle right after
    its scan.  Large tables are left alone: they come in many files and row
    groups, and shuffling them only to spread them would cost real I/O; at
    most ``max_bytes`` ever moves here.  Tables under ``min_bytes`` are not
    worth a stage.
    """
    size = size_in_bytes(df)
    if size is None or not min_bytes <= size <= max_bytes:
        return df
    cores = spark.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores:
        return df
    return df.repartition(cores)


def read_source(spark: SparkSession, sf_dir: str, name: str,
                columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(source_path(sf_dir, name))
    df = spread_small(spark, df)
    return df.select(*columns) if columns else df
