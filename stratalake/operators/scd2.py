"""Type-2 slowly changing dimension, timestamp strategy (SC1, SC2, J8).

A key gets a new version when a batch carries an ``updated_at`` later than the
one of its open version; the open version is closed at that ``updated_at``.
A batch without the key, or with an equal or older ``updated_at``, changes
nothing (no hard deletes).  Attribute changes without an ``updated_at`` change
open no version.

Output columns: the staged columns, then ``scd_id`` (version surrogate key),
``valid_from`` and ``valid_to`` (null while the version is open).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import version_key
from .dedup import _order, latest_per_key

SCD_COLS = ("scd_id", "valid_from", "valid_to")


def scd2_rebuild(history: DataFrame, key: str, updated_at: str, batch: str,
                 attrs: Sequence[str], tie_break: Sequence[str | Column] = ()) -> DataFrame:
    """SC2: the full version history in one pass over every staged batch.

    ``history`` holds every staged row of every batch, ``batch`` orders the
    batches (the ingest stamp).  Equal to replaying :func:`scd2_merge` after
    each batch in order, but stateless and idempotent.

    1. per (key, batch) keep the row the refine would pick (newest
       ``updated_at``, then ``tie_break``);
    2. keep a key's first row, and a later batch's only if its ``updated_at``
       beats every earlier batch's (running max over preceding batches); a
       first row without ``updated_at`` is never beaten, as in the merge;
    3. ``valid_to`` is the next kept version's ``valid_from``.

    Step 1 is a top-1 per (key, batch) that Catalyst runs partly before its
    shuffle (``WindowGroupLimit``), so even a key sent many times in one
    extract ships at most one row per map partition.  After it a key holds at
    most one row per ingested batch; steps 2-3 share one shuffle on the key.
    """
    ordered = [F.col(updated_at).desc_nulls_last(), *[_order(c) for c in tie_break]]
    by_batch = Window.partitionBy(key).orderBy(batch)
    before = by_batch.rowsBetween(Window.unboundedPreceding, -1)
    staged = (latest_per_key(history.select(*attrs, batch), [key, batch], ordered)
              .withColumn("__nth", F.row_number().over(by_batch))
              .withColumn("__first", F.first(updated_at).over(by_batch))
              .withColumn("__prev", F.max(updated_at).over(before))
              .where((F.col("__nth") == 1)
                     | (F.col("__first").isNotNull() & (F.col(updated_at) > F.col("__prev")))))
    return staged.select(
        *attrs,
        version_key(key, updated_at).alias("scd_id"),
        F.col(updated_at).alias("valid_from"),
        F.lead(updated_at).over(by_batch).alias("valid_to"),
    )


def scd2_merge(history: DataFrame | None, staged: DataFrame, key: str,
               updated_at: str) -> DataFrame:
    """SC1: apply one staged batch (current rows, one per key) to a history.

    One pass: a FULL OUTER join whose condition admits only open versions.  A
    version is carried (closed before, no batch row, or not newer) or changed
    (closed at the new ``updated_at``, and a new one opens); a batch row that
    met no open version is new.  ``history`` occurs once in the plan, so merges
    chained without a write grow linearly.  The result must be written to a new
    location before it replaces ``history``.
    """
    attrs = staged.columns
    opened = F.struct(*[F.col(f"s.{c}").alias(c) for c in attrs],
                      version_key(F.col(f"s.{key}"), F.col(f"s.{updated_at}")).alias("scd_id"),
                      F.col(f"s.{updated_at}").alias("valid_from"),
                      F.lit(None).cast("timestamp_ntz").alias("valid_to"))
    if history is None:
        return staged.alias("s").select(opened.alias("v")).select("v.*")

    j = history.alias("o").join(
        staged.alias("s"),
        (F.col(f"o.{key}") == F.col(f"s.{key}")) & F.col("o.valid_to").isNull(), "full_outer")
    o_here = F.col(f"o.{key}").isNotNull()
    s_here = F.col(f"s.{key}").isNotNull()
    changed = o_here & s_here & (F.col(f"s.{updated_at}") > F.col(f"o.{updated_at}"))
    carried = F.struct(*[F.col(f"o.{c}").alias(c) for c in attrs],
                       F.col("o.scd_id").alias("scd_id"),
                       F.col("o.valid_from").alias("valid_from"),
                       F.when(changed, F.col(f"s.{updated_at}"))
                        .otherwise(F.col("o.valid_to")).alias("valid_to"))
    rows = F.array(F.when(o_here, carried), F.when(s_here & (~o_here | changed), opened))
    return (j.select(F.explode(rows).alias("v"))
             .where(F.col("v").isNotNull())
             .select("v.*"))


# ---- late batches ----------------------------------------------------------------
# A batch may arrive after batches of later stamps.  Versions alone do not say what
# it does to them, so the stored state of a key is its *chain*: the rows, with the
# stamp of their batch, that can still become versions.  Adding a row only raises
# the running maximum behind it, so a row outside the chain stays outside, and the
# chain of (chain + batch) is the chain of all rows ever sent.

def scd2_chain(rows: DataFrame, key: str, updated_at: str, batch: str,
               attrs: Sequence[str], tie_break: Sequence[str | Column] = ()) -> DataFrame:
    """The chain of every key: ``attrs`` and ``batch`` of its first row and of
    each later batch's row whose ``updated_at`` beats all earlier batches'.

    Several rows of one (key, batch) count once, the one the refine would pick.
    A first row without ``updated_at`` is never beaten (see :func:`scd2_rebuild`),
    but the rows behind it stay in the chain: an earlier batch may still come."""
    ordered = [F.col(updated_at).desc_nulls_last(), *[_order(c) for c in tie_break]]
    by_batch = Window.partitionBy(key).orderBy(batch)
    before = by_batch.rowsBetween(Window.unboundedPreceding, -1)
    picked = (latest_per_key(rows.select(*attrs, batch), [key, batch], ordered)
              .withColumn("__nth", F.row_number().over(by_batch))
              .withColumn("__prev", F.max(updated_at).over(before)))
    kept = (F.col("__nth") == 1) | (F.col(updated_at).isNotNull()
                                    & (F.col("__prev").isNull() | (F.col(updated_at) > F.col("__prev"))))
    return picked.where(kept).drop("__nth", "__prev")


def scd2_versions(chain: DataFrame, key: str, updated_at: str, batch: str,
                  attrs: Sequence[str]) -> DataFrame:
    """The version history that a chain stands for; equal to
    :func:`scd2_rebuild` over all rows the chain was made of."""
    by_batch = Window.partitionBy(key).orderBy(batch)
    kept = (chain.withColumn("__nth", F.row_number().over(by_batch))
            .withColumn("__first", F.first(updated_at).over(by_batch))
            .where((F.col("__nth") == 1) | F.col("__first").isNotNull()))
    return kept.select(
        *attrs,
        version_key(key, updated_at).alias("scd_id"),
        F.col(updated_at).alias("valid_from"),
        F.lead(updated_at).over(by_batch).alias("valid_to"),
    )


def scd2_decisive(chain: DataFrame, rows: DataFrame, key: str, updated_at: str, batch: str,
                  attrs: Sequence[str], tie_break: Sequence[str | Column] = ()) -> DataFrame:
    """The rows of a batch that change the chain of their key, whatever the
    batch's place among those already in it, and ``since``: the time from which
    the key's versions differ, null if from its beginning.

    Only the key, stamp and time of the chain are read.  A daily full extract
    repeats most rows, and all those drop out here; so does a batch sent again."""
    ordered = [F.col(updated_at).desc_nulls_last(), *[_order(c) for c in tie_break]]
    picked = latest_per_key(rows.select(*attrs, batch), [key, batch], ordered)
    old = chain.select(F.col(key).alias("__key"), F.col(batch).alias("__batch"), F.col(updated_at).alias("__at"),
                       F.struct(*[F.col(a) for a in attrs]).alias("__row"))
    met = picked.join(old, F.col(key) == F.col("__key"), "left")
    earlier = F.col("__batch") < F.col(batch)
    later = F.col("__batch") >= F.col(batch)
    one = met.groupBy(batch, *attrs).agg(
        F.count("__batch").alias("__n"),
        F.count_if(earlier).alias("__earlier"),
        F.max(F.when(earlier, F.col("__at"))).alias("__prev"),
        F.count_if((F.col("__batch") == F.col(batch))
                   & F.col("__row").eqNullSafe(F.struct(*[F.col(a) for a in attrs]))).alias("__again"),
        F.min(F.when(later, F.col("__at"))).alias("__next"),
        F.count_if(later & F.col("__at").isNull()).alias("__timeless"))
    beats = F.col(updated_at).isNotNull() & (F.col("__prev").isNull() | (F.col(updated_at) > F.col("__prev")))
    since = F.when((F.col("__n") > 0) & (F.col("__timeless") == 0) & F.col(updated_at).isNotNull(),
                   F.least(updated_at, F.coalesce("__next", F.col(updated_at))))
    return (one.where(((F.col("__earlier") == 0) | beats) & (F.col("__again") == 0))
            .select(*attrs, batch, since.alias("since")))


def scd2_splice(chain: DataFrame, decisive: DataFrame, key: str, updated_at: str, batch: str,
                attrs: Sequence[str], tie_break: Sequence[str | Column] = ()) -> DataFrame:
    """The chain with the decisive rows of a batch in their place.  Only the
    chains of their keys are windowed again; all others are carried as they are."""
    keys = decisive.select(key).distinct()
    rows = decisive.select(*attrs, batch)
    mended = scd2_chain(chain.join(keys, key, "left_semi").select(*attrs, batch).unionByName(rows),
                        key, updated_at, batch, attrs, tie_break)
    return chain.join(keys, key, "left_anti").select(*attrs, batch).unionByName(mended)
