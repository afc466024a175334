"""Latest row per natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(c) -> Column:
    if isinstance(c, Column):
        return c
    if c.startswith("-"):
        return F.col(c[1:]).desc_nulls_last()
    return F.col(c).asc_nulls_first()


def latest_per_key(df: DataFrame, keys: str | Sequence[str],
                   order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row of every key group under ``order``.

    ``order`` items are column names (``"-col"`` = descending, nulls last;
    ``"col"`` = ascending, nulls first) or explicit sort Columns.  Give enough
    columns to make the order total, otherwise ties are broken arbitrarily.

    ``row_number() = 1`` over the key window is planned by Catalyst as a
    ``WindowGroupLimit``: a partial top-1 runs *before* the shuffle, so even a
    key holding a third of all rows ships at most one row per map partition.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*[_order(c) for c in order])
    rn = "__rn"
    return (df.withColumn(rn, F.row_number().over(w))
              .where(F.col(rn) == 1)
              .drop(rn))
