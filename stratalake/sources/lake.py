"""Lake layout and the table-level sources and sinks.

Landed extracts lie in ``raw`` by table and day.  ``bronze`` only grows, a
partition for each extract date and, below it, one for each append; ``silver``
and ``gold`` are replaced as wholes (``Lake.overwrite``, a folder for each
version) or by partitions, ``serving`` is the copy of silver that contracts
read and ``state`` holds the tables of the incremental mode.

The root is any Hadoop-compatible URI (object store, HDFS, local).  The table
format is a parameter: ``parquet`` by default, ``delta`` where the connector is
on the classpath.  Writes go through Spark's job commit protocol, so a lost
executor only re-runs its tasks; a failed overwrite leaves the table it was to
replace.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir
from .schemas import EXTRACT_DATE, INGESTED_AT


RAW_PARTITION = "extract_date"
#: Parquet codec of all that the lake stores: a third less to write and to read back than Spark's default.
CODEC = "zstd"


@dataclass(frozen=True)
class Lake:
    root: str
    fmt: str = "parquet"

    # ---- layout -------------------------------------------------------------
    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def raw_root(self, table: str) -> str:
        return self._p("raw", table)

    def raw_path(self, extract_date: str, table: str) -> str:
        return self._p("raw", table, f"{RAW_PARTITION}={extract_date}")

    def bronze_path(self, table: str) -> str:
        return self._p("bronze", table)

    def silver_path(self, table: str) -> str:
        return self._p("silver", table)

    def serving_path(self, table: str) -> str:
        return self._p("serving", table)

    def gold_path(self, table: str) -> str:
        return self._p("gold", table)

    def state_path(self, name: str) -> str:
        return self._p("state", name)

    # ---- sources (S1, S2, S6) ----------------------------------------------
    def read(self, spark: SparkSession, path: str, schema: StructType | None = None,
             fmt: str | None = None) -> DataFrame:
        fmt = fmt or self.fmt
        reader = spark.read.format(fmt)
        if schema is not None and fmt != "delta":   # delta tables carry their schema
            reader = reader.schema(schema)
        return reader.load(current_folder(spark, path))

    def read_raw(self, spark, extract_date: str, table: str,
                 schema: StructType | None = None) -> DataFrame:
        # the landing zone is always plain parquet
        return self.read(spark, self.raw_path(extract_date, table), schema, fmt="parquet")

    # ---- sinks (S3, S4, S5) ------------------------------------------------
    def append(self, df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
        """Add rows to a table.  The append's id is its last partition folder, so
        appends can be told apart afterwards, whatever stamps their rows carry."""
        w = df if self.fmt == "delta" else df.withColumn(COMMIT, F.lit(commit_id()))
        by = [*(partition_by or []), *([] if self.fmt == "delta" else [COMMIT])]
        w = w.write.format(self.fmt).option("compression", CODEC).mode("append")
        if by:
            w = w.partitionBy(*by)
        w.save(path)

    def overwrite(self, df: DataFrame, path: str, partition_by: list[str] | None = None,
                  fmt: str | None = None, **options) -> None:
        """Replace a table; readers see the old one until the write has committed.

        Delta commits atomically itself.  Other formats get a folder for each
        version; the newest one that Spark's commit has marked is the table.
        Nothing is renamed or copied, and a write that broke off leaves a folder
        that nobody reads and the next overwrite removes.  The version before
        stays for readers that have begun."""
        fmt = fmt or self.fmt
        spark = df.sparkSession
        if fmt == "delta":
            new, old = path, []
        else:
            marked = table_versions(spark, path)
            number = (marked[-1] if marked else 0) + 1
            new = f"{path.rstrip('/')}/{_version_folder(number)}"
            stay = {_version_folder(v) for v in (*marked[-1:], number)}
            old = [n for n in list_names(spark, path) if n not in stay]
            delete(spark, new)
        w = (by_partition(df, *partition_by) if partition_by else df).write.format(fmt).mode("overwrite").options(
            **{"compression": CODEC, **options})
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(new)
        for name in old:
            delete(spark, f"{path.rstrip('/')}/{name}")
        spark.catalog.refreshByPath(path)

    def overwrite_partitions(self, df: DataFrame, path: str, column: str, values,
                             fmt: str | None = None) -> None:
        """Replace the partitions ``values`` of ``column`` by the rows of ``df``,
        which all lie in them; one left without rows goes, others stay as they are.

        Files are staged and moved when the job commits, so ``df`` may read the
        table it goes to."""
        fmt = fmt or self.fmt
        if fmt == "delta":
            listed = ", ".join("'" + str(v).replace("'", "''") + "'" for v in sorted(values))
            (df.write.format(fmt).mode("overwrite").partitionBy(column)
               .option("replaceWhere", f"{column} IN ({listed})").save(path))
            return
        spark = df.sparkSession
        path = current_folder(spark, path)
        seen = Observation()
        (by_partition(df.observe(seen, F.collect_set(column).alias("values")), column)
           .write.format(fmt).option("compression", CODEC).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).save(path))
        for v in set(values) - set(seen.get["values"]):
            delete(spark, f"{path.rstrip('/')}/{column}={v}")
        spark.catalog.refreshByPath(path)

    def export(self, df: DataFrame, path: str, by: str, rows_per_file: int = 5_000_000) -> None:
        """A plain Parquet copy in ranges of ``by``.

        Ranges are cut from the data's own quantiles, so files are of a size,
        however ``by`` is distributed, and the minima and maxima in their
        footers do not overlap: a predicate on ``by`` skips files and row groups."""
        ranged = df.repartitionByRange(F.col(by)).sortWithinPartitions(by)
        self.overwrite(ranged, path, fmt="parquet", maxRecordsPerFile=rows_per_file)

    def partitioned(self, spark: SparkSession, path: str, column: str) -> bool:
        """True when ``path`` holds a table laid out by ``column``."""
        return bool(names_like(spark, current_folder(spark, path), f"{column}=*", first=True))

    # ---- metadata (S9-S11) -------------------------------------------------
    def exists(self, spark: SparkSession, path: str, fmt: str | None = None) -> bool:
        """True when ``path`` holds a table (S9); a table that cannot be read is an error, not absent."""
        if not list_names(spark, path):
            return False
        try:
            self.read(spark, path, fmt=fmt).schema  # resolves the table, reads no rows
            return True
        except AnalysisException as e:
            if e.getCondition() in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
                return False
            raise


def by_partition(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of a partition together, so it gets few files; AQE cuts a large one
    into several tasks and joins small ones, by their measured size."""
    return df.hint("rebalance", *columns)


def scratch_lake(spark: SparkSession) -> Lake:
    """A lake of its own below the shared folder that the session names in ``spark.checkpoint.dir``."""
    shared = ensure_checkpoint_dir(spark)
    if shared is None:
        raise RuntimeError("stored layers need a shared folder: set spark.checkpoint.dir")
    return Lake(f"{shared.rstrip('/')}/stratalake-{uuid.uuid4().hex}")


# ---- versioned state tables -----------------------------------------------------
# A state table (e.g. the latest row per key, the SCD2 history) is replaced on
# every run but must never be overwritten while it is being read.  Each run
# writes a NEW partition ``_v=<version>`` (dynamic partition overwrite, so a
# retried run replaces its own version instead of duplicating it) and readers
# prune to the newest version.  Versions are fixed-width strings that sort in
# time order.

VERSION_COL = "_v"


def next_version(current: str | None) -> str:
    """The commit number after ``current``, fixed-width."""
    return f"{int(current or 0) + 1:020d}"


def write_version(df: DataFrame, path: str, version: str) -> None:
    (df.withColumn(VERSION_COL, F.lit(version))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC)
       .partitionBy(VERSION_COL).parquet(path))


def _fs(spark: SparkSession, path: str):
    """Hadoop FileSystem and Path for ``path`` (any Hadoop URI)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names right under a folder; none where there is no folder."""
    return names_like(spark, path, "*")


def names_like(spark: SparkSession, path: str, pattern: str, first: bool = False) -> list[str]:
    """Names right under a folder that fit a glob pattern, or one of them."""
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs, p = _fs(spark, path)
    found = fs.globStatus(path_of(p, pattern)) or []
    return sorted(st.getPath().getName() for st in (found[:1] if first and len(found) else found))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of the lake with all it holds; no error where there is none."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


# ---- versions of replaced tables ---------------------------------------------------

_VERSION_FOLDER = "v="


def _version_folder(n: int) -> str:
    return f"{_VERSION_FOLDER}{n:08d}"


def table_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of a replaced table's committed versions, oldest first."""
    fs, p = _fs(spark, path)
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return [int(n.removeprefix(_VERSION_FOLDER)) for n in names_like(spark, path, f"{_VERSION_FOLDER}*")
            if fs.exists(path_of(path_of(p, n), "_SUCCESS"))]


def current_folder(spark: SparkSession, path: str) -> str:
    """Where the files of a table lie: its newest committed version, or the path itself."""
    marked = table_versions(spark, path)
    return f"{path.rstrip('/')}/{_version_folder(marked[-1])}" if marked else path


def list_versions(spark: SparkSession, path: str) -> list[str]:
    """Committed version tags of a state table, oldest first.

    Lists only the table's top-level ``_v=`` folders (one per version), not
    its data files, so the cost does not grow with the table.  A version
    folder appears only when its write job commits (dynamic partition
    overwrite stages files and moves whole partitions at commit)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    tags = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(VERSION_COL + "="):
            tags.append(name.split("=", 1)[1])
    return sorted(tags)


def current_version(spark: SparkSession, path: str, before: str | None = None) -> str | None:
    """Newest version tag of a state table (optionally strictly older than
    ``before``); None if there is none."""
    tags = [t for t in list_versions(spark, path) if before is None or t < before]
    return tags[-1] if tags else None


def prune_versions(spark: SparkSession, path: str, keep_from: str) -> list[str]:
    """Delete the versions older than ``keep_from`` (retention).

    A run reads version ``prev`` and writes version ``v``; keeping everything
    from ``prev`` on lets a retried run rebuild ``v`` from the same input,
    while storage stays at about two copies of the state instead of one copy
    per run.  Returns the removed tags."""
    fs, p = _fs(spark, path)
    gone = [t for t in list_versions(spark, path) if t < keep_from]
    for t in gone:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, f"{VERSION_COL}={t}"), True)
    return gone


def read_version(spark: SparkSession, path: str, version: str,
                 schema: StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        from pyspark.sql.types import StringType, StructField
        reader = reader.schema(StructType(list(schema.fields)
                                          + [StructField(VERSION_COL, StringType())]))
    return (reader.parquet(path)
            .where(F.col(VERSION_COL) == F.lit(version))
            .drop(VERSION_COL))


# ---- appends and counts from the files themselves -----------------------------------

COMMIT = "_commit"


def commit_id() -> str:
    """Sorts by time; unique."""
    return f"{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def footer_scan(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table read by Spark's newer file source, whose counts, and
    bounds of numbers and dates, come from the file footers: no rows are read."""
    conf = "spark.sql.sources.useV1SourceList"
    old = spark.conf.get(conf)
    spark.conf.set(conf, "")
    try:
        return spark.read.parquet(current_folder(spark, path))
    finally:
        spark.conf.set(conf, old)


def _appended(spark: SparkSession, path: str) -> DataFrame:
    """(commit, rows) of a bronze table; footers count rows by all partition columns."""
    rows = footer_scan(spark, path).groupBy(EXTRACT_DATE, COMMIT).agg(F.count(F.lit(1)).alias("rows"))
    return rows.groupBy(COMMIT).agg(F.sum("rows").alias("rows"))


def append_history(spark: SparkSession, path: str) -> DataFrame:
    """One row per append of a stored table (S11): 0-based version, rows.

    Appends count and not ingest stamps, so two appends of one stamp are two
    versions."""
    from pyspark.sql import Window

    rows = _appended(spark, path)
    # one row per append
    return rows.select((F.row_number().over(Window.orderBy(COMMIT)) - 1).cast("bigint").alias("version"),
                       F.col(COMMIT).alias("commit"), "rows")


def append_version(spark: SparkSession, path: str) -> DataFrame:
    """Latest 0-based version and row count of a stored table."""
    rows = _appended(spark, path)
    return rows.agg((F.count(F.lit(1)) - 1).alias("version"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))


def table_history(bronze: DataFrame) -> DataFrame:
    """One row per commit of an append-only bronze table.

    Each ingest stamps one ``_ingested_at`` value, so commits are the distinct
    ingest stamps; ``version`` is 0-based in commit order.  The grouping is a
    partial aggregate, so only one row per commit and partition is shuffled.
    """
    from pyspark.sql import Window

    commits = bronze.groupBy(INGESTED_AT, EXTRACT_DATE).agg(F.count(F.lit(1)).alias("rows"))
    # one row per commit: a handful of rows, so a single window partition is fine
    order = Window.orderBy(INGESTED_AT, EXTRACT_DATE)
    return commits.select(
        (F.row_number().over(order) - 1).cast("bigint").alias("version"),
        F.col(EXTRACT_DATE).alias("extract_date"),
        F.col(INGESTED_AT).alias("ingested_at"),
        "rows",
    )


def table_version(bronze: DataFrame) -> DataFrame:
    """Latest 0-based commit number and row count of a bronze table."""
    return bronze.agg(
        (F.count_distinct(F.col(INGESTED_AT)) - 1).alias("version"),
        F.count(F.lit(1)).alias("rows"),
    )
