"""Keyed state in Spark's bucketed tables: one row per key, merged without moving the state (W1, W2, SV5).

The table is partitioned into hash parts of the key and, inside a part,
bucketed by the key.  A merge joins the state with a batch on the key: the
scan of the state already is hash partitioned by it, so only the batch is
shuffled; and only the parts in which a row changes are written again, by a
dynamic partition overwrite, which moves staged files in when the job commits.
Taking a batch again changes nothing.

The session's catalog knows the table by name; the files are an external
folder, declared anew in each session.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.dedup import latest_per_key
from .lake import names_like

PART = "_p"
#: Parts of a table: how finely a merge picks what it writes.  Buckets of a part: how many tasks merge it.  Both
#: should grow with the table, to some 100 MB a bucket; they belong to its layout.
PARTS, BUCKETS = 4, 4


def beats(new: str, old: str, order: Sequence[str]) -> Column:
    """Whether row ``new`` comes before row ``old`` in an order of columns
    (``"-col"``: descending, nulls last; ``"col"``: ascending, nulls first)."""
    out = F.lit(False)
    for c in reversed(order):
        name = c.removeprefix("-")
        a, b = F.col(f"{new}.{name}"), F.col(f"{old}.{name}")
        if c.startswith("-"):
            first = (a.isNotNull() & b.isNull()) | F.coalesce(a > b, F.lit(False))
        else:
            first = (a.isNull() & b.isNotNull()) | F.coalesce(a < b, F.lit(False))
        out = first | (a.eqNullSafe(b) & out)
    return out


class BucketedState:
    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str, order: Sequence[str],
                 parts: int = PARTS, buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.key, self.order = spark, path.rstrip("/"), schema, key, list(order)
        self.parts, self.buckets = parts, buckets
        self.name = "state_" + hashlib.md5(self.path.encode()).hexdigest()

    def exists(self) -> bool:
        return bool(names_like(self.spark, self.path, f"{PART}=*"))

    def _declare(self) -> None:
        if not self.spark.catalog.tableExists(self.name):
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            self.spark.sql(f"CREATE TABLE {self.name} ({cols}, {PART} INT) USING parquet PARTITIONED BY ({PART}) "
                           f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS "
                           f"LOCATION '{self.path}' OPTIONS (partitionOverwriteMode 'dynamic')")
            if self.exists():
                self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    def rows(self) -> DataFrame:
        self._declare()
        return self.spark.table(self.name).select(*self.schema.fieldNames())

    def part_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.parts)).cast("int")

    def merged(self, batch: DataFrame, parts: Sequence[int], null_keys: bool = False) -> DataFrame:
        """The state rows of some parts with a batch (one row per key) taken in; ``__changed`` marks its winners.

        Rows without a key share one group, as in a window; ``null_keys`` says whether the batch has any."""
        self._declare()
        cols, key = self.schema.fieldNames(), self.key
        held = self.spark.table(self.name).where(F.col(PART).isin(list(parts))).select(*cols)
        sent = batch.select(*cols).where(self.part_of(F.col(key)).isin(list(parts)))
        j = held.where(F.col(key).isNotNull()).alias("o").join(
            sent.where(F.col(key).isNotNull()).alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
        wins = F.col(f"n.{key}").isNotNull() & (F.col(f"o.{key}").isNull() | beats("n", "o", self.order))
        rows = j.withColumn("__changed", wins).select(*[
            F.when(F.col("__changed"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in cols], "__changed")
        loose = held.where(F.col(key).isNull()).withColumn("__changed", F.lit(False))
        if null_keys:
            loose = latest_per_key(loose.unionByName(sent.where(F.col(key).isNull()).withColumn("__changed", F.lit(True))),
                                   key, [*self.order, "__changed"])
        return rows.unionByName(loose).withColumn(PART, self.part_of(F.col(key)))

    def merge(self, batch: DataFrame) -> set[int]:
        """Take a batch in; returns the parts written."""
        key = F.col(self.key)
        met = batch.select(self.part_of(key).alias("p"), key.isNull().alias("loose")).distinct().collect()  # <= 2 x parts
        loose = any(r["loose"] for r in met)
        merged = self.merged(batch, sorted({r["p"] for r in met}), loose)
        changed = {r[0] for r in merged.where("__changed").select(PART).distinct().collect()}
        if changed:
            rows = self.merged(batch, sorted(changed), loose).select(*self.schema.fieldNames(), PART)
            rows.write.insertInto(self.name, overwrite=True)   # these parts only, by the table's options
            self.spark.catalog.refreshTable(self.name)
        return changed
