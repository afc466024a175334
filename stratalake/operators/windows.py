"""Window helpers that stay parallel when one key holds a large share of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---- fixed values ---------------------------------------------------------------
MAX_BUCKET_ROWS = 1_000_000        # rows of one (key, bucket) before it is cut into slices
# ---------------------------------------------------------------------------------


def slice_hot_buckets(df: DataFrame, key: str, ts: str, bucket: str, out: str,
                      max_rows: int | None = MAX_BUCKET_ROWS) -> DataFrame:
    """Add ``out``: a slice number that cuts every (key, bucket) group of more
    than ``max_rows`` rows into ``ceil(rows / max_rows)`` equal time slices
    between the group's own first and last ``ts`` (0 elsewhere).

    (bucket, slice) is still non-decreasing in time and a deterministic
    function of the rows, so windows over (key, bucket, slice) give the same
    result on every run and retry.  Groups are counted with map-side partial
    counts, so a hot group collapses before the shuffle; only rows that share
    one identical microsecond cannot be cut apart."""
    if not max_rows:
        return df.withColumn(out, F.lit(0).cast("bigint"))
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    hot = (df.groupBy(key, bucket)
             .agg(F.count(F.lit(1)).alias("__n"), F.min(us).alias("__lo"),
                  F.max(us).alias("__hi"))
             .where(F.col("__n") > max_rows)
             .select(key, bucket, F.ceil(F.col("__n") / F.lit(max_rows)).alias("__pieces"),
                     "__lo", "__hi"))
    piece = F.floor((us - F.col("__lo")).cast("double") * F.col("__pieces")
                    / (F.col("__hi") - F.col("__lo") + 1).cast("double"))
    return (_join_null_safe(df, hot, [key, bucket])
              .withColumn(out, F.coalesce(piece.cast("bigint"), F.lit(0).cast("bigint")))
              .drop("__pieces", "__lo", "__hi"))


def _join_null_safe(left: DataFrame, right: DataFrame, cols: list[str]) -> DataFrame:
    """Left join on ``cols`` where null equals null (a null key is one window
    group, so its rows must find their group's row); keeps ``left``'s key
    columns.  Planned as an equi join."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") for c in cols],
                     *[c for c in right.columns if c not in cols])
    cond = None
    for c in cols:
        eq = left[c].eqNullSafe(r[f"__r_{c}"])
        cond = eq if cond is None else cond & eq
    return left.join(r, cond, "left").drop(*[f"__r_{c}" for c in cols])


def next_in_key(df: DataFrame, key: str, ts: str, tie: str, bucket: Column,
                out: str = "next_ts", max_bucket_rows: int | None = MAX_BUCKET_ROWS) -> DataFrame:
    """``out`` = ``ts`` of the next row of the same ``key`` in (ts, tie) order,
    null for the last row: ``lead(ts)`` over ``partitionBy(key)``, computed
    without putting a whole key into one task.

    ``bucket`` must be non-decreasing in ``ts`` (e.g. ``date_trunc('hour', ts)``);
    hot buckets are further cut into time slices (:func:`slice_hot_buckets`).
    Rows get their successor inside their (key, bucket, slice) window; the
    last row of a slice takes the first row of the key's next non-empty slice,
    found on a table of one row per slice (pre-aggregated, so its per-key
    window holds one row per slice, not one per event).  A hot key is spread
    over as many tasks as it has slices.
    """
    b, s = "__bucket", "__slice"
    d = slice_hot_buckets(df.withColumn(b, bucket), key, ts, b, s, max_bucket_rows)
    within = Window.partitionBy(key, b, s).orderBy(ts, tie)
    d = d.withColumn("__next_in", F.lead(ts).over(within))
    firsts = d.groupBy(key, b, s).agg(F.min(F.struct(F.col(ts).alias("t"), F.col(tie).alias("k")))
                                      .alias("__first"))
    across = Window.partitionBy(key).orderBy(b, s)
    nxt = firsts.select(key, b, s, F.lead(F.col("__first.t")).over(across).alias("__next_b"))
    return (_join_null_safe(d, nxt, [key, b, s])
             .withColumn(out, F.coalesce("__next_in", "__next_b"))
             .drop(b, s, "__next_in", "__next_b"))
