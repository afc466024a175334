"""Helpers shared by the operators: settings, shared scratch tables, exact ranks.

Intermediate tables go to the folder the cluster names in
``spark.checkpoint.dir``, which driver and executors share, so a lost executor
costs a re-read and no recomputation.  Only a local-mode session without that
setting (tests) gets a folder of its own; on a cluster its absence is an error.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of an Arrow batch: texts reach 100 kB and more, so batches stay small.
BATCH_ROWS = 256

#: A word is a maximal run of characters other than space, \\t, \\n, \\v, \\f, \\r.
WORD = r"[^\x20\x09-\x0D]+"


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_stratalake_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    target = Path(tempfile.mkdtemp(prefix="stratalake-code-")) / "stratalake_code.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted((root / "stratalake").rglob("*.py")):
            z.write(f, f.relative_to(root))
    sc.addPyFile(str(target))
    sc._stratalake_shipped = True


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on."""
    ship_package(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster, or one of our own in local mode where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("name a folder that driver and executors share in spark.checkpoint.dir")
        named = tempfile.mkdtemp(prefix="stratalake-llm-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back, which cuts lineage."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def quoted(name: str) -> str:
    """A column's name as SQL text, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_column(df: DataFrame, column: str, added: dict[str, str],
               batches: Callable[[Iterator[pd.Series]], Iterator[pd.DataFrame]]) -> DataFrame:
    """``df`` without ``column``, followed by the ``added`` columns (name: type) that ``batches`` makes of it.

    ``batches`` turns each batch's values into a frame of the added columns, in
    order.  The other columns pass through under numbers, so their names may
    hold any character; those named like an added one are replaced.
    """
    names = [c for c in df.columns if c != column and c not in added]
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    inner = [f"c{i}" for i in range(len(names))]
    new = [f"n{i}" for i in range(len(added))]
    schema = ", ".join(f"{c} {t}" for c, t in zip(inner + new, [types[n] for n in names] + list(added.values())))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def values() -> Iterator[pd.Series]:
            for pdf in frames:
                held.append(pdf)
                yield pdf["value"]

        for got in batches(values()):
            pdf = held.pop()
            yield pd.concat([pdf.drop(columns="value"), got.set_axis(new, axis=1).set_index(pdf.index)], axis=1)

    return (df.select(*[F.col(quoted(n)).alias(c) for n, c in zip(names, inner)], F.col(quoted(column)).alias("value"))
            .mapInPandas(run, schema).toDF(*names, *added))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one table of ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def hash_bucket(key: Column, n: int) -> Column:
    """Bucket 0..n-1 of a hexadecimal digest by its first eight digits, in key order."""
    return (F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * F.lit(n) / F.lit(1 << 32)).cast("long")


def buckets_for(rows: int, per_bucket: int = 8192) -> int:
    """Number of hash buckets such that one bucket of one group holds about ``per_bucket`` rows."""
    return max(1, -(-int(rows) // per_bucket))


def running_total(df: DataFrame, group: list[str], bucket: str, order: list[str], value: str,
                  out: str, per_group: DataFrame | None = None) -> DataFrame:
    """Exclusive running sum of ``value`` within ``group``, in the order of (bucket, *order).

    A distributed prefix sum: buckets are summed (map-side combined), a window
    over one row per bucket gives each bucket's start, and rows are summed
    only inside their bucket, so a group with a third of all rows is spread
    over all of its buckets.  Group values may be null.  ``per_group`` (the
    group columns and others) is joined to the bucket starts, so its columns
    reach the rows without a join on the hot group alone.
    """
    starts = (df.groupBy(*group, bucket).agg(F.sum(value).alias("__sum"))
              .withColumn("__start", F.coalesce(F.sum("__sum").over(
                  Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)),
                  F.lit(0).cast("long"))).drop("__sum"))
    starts = starts.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)],
                           F.col(bucket).alias("__gb"), "__start")
    if per_group is not None:
        keys = [F.col(g).alias(f"__p{i}") for i, g in enumerate(group)]
        per_group = per_group.select(*keys, *[c for c in per_group.columns if c not in group])
        same = F.lit(True)
        for i in range(len(group)):
            same = same & F.col(f"__g{i}").eqNullSafe(F.col(f"__p{i}"))
        starts = starts.join(per_group, same).drop(*[f"__p{i}" for i in range(len(group))])
    inside = F.sum(value).over(Window.partitionBy(*group, bucket).orderBy(*order)
                               .rowsBetween(Window.unboundedPreceding, -1))
    rows = df.withColumn("__inside", F.coalesce(inside, F.lit(0).cast("long")))
    same = F.col(bucket) == F.col("__gb")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    return (rows.join(starts, same).withColumn(out, F.col("__start") + F.col("__inside"))
            .drop("__gb", "__start", "__inside", *[f"__g{i}" for i in range(len(group))]))
