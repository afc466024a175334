"""Join operators: referential semi/anti joins, the point-in-time join and the
backward as-of join.

No join here forces a broadcast.  Spark's adaptive execution turns a
sort-merge join into a broadcast join only when the measured size of a side is
under ``spark.sql.autoBroadcastJoinThreshold``, and splits a skewed partition
of the preserved side when one key dominates.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import valid_to_or_open
from .windows import MAX_BUCKET_ROWS, slice_hot_buckets


def keep_matching(df: DataFrame, ref: DataFrame, key: str,
                  ref_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` exists in ``ref`` (a left semi join).
    Only the key column of ``ref`` is read."""
    ref_key = ref_key or key
    r = ref.select(F.col(ref_key).alias(key))
    return df.join(r, key, "left_semi")


def missing_from(df: DataFrame, ref: DataFrame, key: str,
                 ref_key: str | None = None) -> DataFrame:
    """Rows of ``df`` with a non-null ``key`` absent from ``ref``
    (referential-integrity violations; null keys are not checked)."""
    ref_key = ref_key or key
    r = ref.select(F.col(ref_key).alias(key))
    return df.where(F.col(key).isNotNull()).join(r, key, "left_anti")


def lookup_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of a large table whose ``key`` is among far fewer ``keys`` (a stored table, such as a batch).

    The keys' own range becomes a predicate of both sides: row groups of ``df``
    outside it are not read, and Spark takes the keys for a selective side and
    checks a Bloom filter of them in the scan of ``df``, before its shuffle,
    where ``df`` is large and the keys are within the thresholds of
    ``spark.sql.optimizer.runtime.bloomFilter``.  Null keys match nothing; no
    keys give no rows."""
    least, most = keys.agg(F.min(key), F.max(key)).first()
    if least is None:
        return df.where(F.lit(False))
    kind = keys.schema[key].dataType
    ranged = keys.select(key).where((F.col(key) >= F.lit(least).cast(kind)) & (F.col(key) <= F.lit(most).cast(kind)))
    return df.join(ranged, key, "left_semi")


def pit_join(facts: DataFrame, versions: DataFrame, key: str, ts: str,
             valid_from: str = "valid_from", valid_to: str = "valid_to",
             version_cols: Sequence[str] = (), version_key: str | None = None,
             open_upper: bool = True) -> DataFrame:
    """Point-in-time LEFT join.

    Every fact row is kept once; it picks up the version of its ``key`` whose
    half-open window ``[valid_from, coalesce(valid_to, 9999-12-31))`` holds
    ``ts``.  Facts with no such version keep nulls.  ``version_key`` names the
    key column in ``versions`` when it differs from the facts' ``key``.

    Plan: an equi join on the key with the window as a residual condition
    (hash or sort-merge; broadcast only if AQE measures the versions small).
    Versions of one key never overlap, so the join cannot fan out.
    ``open_upper=False`` drops the open-end coalesce (a known bug, kept only
    so tests can show reconciliation catches it).
    """
    vkey = version_key or key
    v = versions.select(
        F.col(vkey).alias("__vkey"),
        F.col(valid_from).alias("__vfrom"),
        (valid_to_or_open(valid_to) if open_upper else F.col(valid_to)).alias("__vto"),
        *version_cols,
    )
    cond = ((facts[key] == v["__vkey"])
            & (facts[ts] >= v["__vfrom"])
            & (facts[ts] < v["__vto"]))
    return facts.join(v, cond, "left").drop("__vkey", "__vfrom", "__vto")


def overlapping_keys(versions: DataFrame, key: str, valid_from: str = "valid_from",
                     valid_to: str = "valid_to") -> DataFrame:
    """Keys of which two windows overlap, one row each.

    A sweep over the window ends: in order of their starts, a window overlaps
    one before it exactly if it starts before the latest end so far.  Windows
    without a start, or that end where they start, hold nothing and do not count."""
    v = versions.select(F.col(key).alias(key), F.col(valid_from).alias("__from"),
                        valid_to_or_open(valid_to).alias("__to"))
    v = v.where(F.col(key).isNotNull() & (F.col("__from") < F.col("__to")))
    so_far = Window.partitionBy(key).orderBy("__from", "__to").rowsBetween(Window.unboundedPreceding, -1)
    return (v.withColumn("__end", F.max("__to").over(so_far))
            .where(F.col("__from") < F.col("__end")).select(key).distinct())


def sweep_join(facts: DataFrame, versions: DataFrame, key: str, ts: str, version_cols: Sequence[str],
               valid_from: str = "valid_from", valid_to: str = "valid_to",
               bucket: Callable[[Column], Column] | None = None,
               max_bucket_rows: int | None = MAX_BUCKET_ROWS) -> DataFrame:
    """:func:`pit_join`, linear in the versions of a key unless they overlap.

    Keys with overlapping windows (normally none) take the range join and fan
    out as there.  All other facts meet at most one version: the last that
    starts at or before ``ts``, found by :func:`asof_join`, if it has not ended.
    A key with very many versions is never compared with all of them."""
    twisted = overlapping_keys(versions, key, valid_from, valid_to)
    ranged = pit_join(facts.join(twisted, key, "left_semi"), versions.join(twisted, key, "left_semi"),
                      key, ts, valid_from, valid_to, version_cols)
    starts = versions.select(F.col(key).alias(key), F.col(valid_from).alias(ts), F.col(valid_from).alias("__tie"),
                             valid_to_or_open(valid_to).alias("__to"),
                             *[F.col(c).alias(f"__v_{c}") for c in version_cols]).where(F.col(ts) < F.col("__to"))
    plain = asof_join(facts.join(twisted, key, "left_anti"), starts, key, ts, "__tie",
                      ["__to", *[f"__v_{c}" for c in version_cols]], bucket, max_bucket_rows=max_bucket_rows)
    plain = plain.select(*facts.columns, *[F.when(F.col(ts) < F.col("__to"), F.col(f"__v_{c}")).alias(c)
                                           for c in version_cols])
    return plain.unionByName(ranged.select(*plain.columns))


_KIND, _TIE, _EV = "__kind", "__tie", "__ev"      # as-of working columns


def asof_join(facts: DataFrame, starts: DataFrame, key: str, ts: str, tie: str,
              version_cols: Sequence[str], bucket: Callable[[Column], Column] | None = None,
              start_key: str | None = None, start_ts: str | None = None,
              max_bucket_rows: int | None = MAX_BUCKET_ROWS) -> DataFrame:
    """Backward as-of LEFT join: every fact row picks up ``version_cols`` of
    the last row of ``starts`` with the same key and a start time at or
    before the fact's ``ts`` (last in (start time, ``tie``) order).  Facts
    with no such start keep nulls; every fact row is kept exactly once.

    For versions that form a chain (each valid until the next one starts,
    e.g. versions cut from an event stream) this is the same result as
    :func:`pit_join` on the half-open windows, but its cost does not depend
    on how many versions a key has: no fact is ever compared with more than
    one candidate.

    Plan: facts and starts are unioned and shuffled ONCE on (key, time
    bucket); a running ``last`` inside each (key, bucket) window gives the
    latest start so far in the bucket.  Facts that see none take the latest
    start of the key's earlier buckets, from a table of one row per (key,
    bucket) whose per-key window holds one row per bucket, not one per row.
    ``bucket`` must be non-decreasing in time (default: the minute), so a key
    holding a third of all rows is spread over as many tasks as it has
    buckets.

    A bucket may itself be hot (a third of all rows in one key's minute): one
    with more than ``max_bucket_rows`` rows is cut into equal time slices
    between its own first and last timestamp (:func:`slice_hot_buckets`); the
    cut is deterministic and monotone in time, so the result stays exact.
    """
    sk, st = start_key or key, start_ts or ts
    s = (starts.where(F.col(sk).isNotNull() & F.col(st).isNotNull())
         .select(F.col(sk).alias(key), F.col(st).alias(ts), F.lit(0).alias(_KIND),
                 F.col(tie).alias(_TIE),
                 _start_struct(F.col(st), F.col(tie), {c: F.col(c) for c in version_cols})
                 .alias(_EV)))
    u = facts.withColumn(_KIND, F.lit(1)).unionByName(s, allowMissingColumns=True)
    return _asof(u, facts.columns, key, ts, version_cols, bucket, max_bucket_rows)


def asof_within(df: DataFrame, key: str, ts: str, is_start: Column, tie: str,
                fact_cols: Sequence[str], versions: dict[str, Column],
                bucket: Callable[[Column], Column] | None = None,
                max_bucket_rows: int | None = MAX_BUCKET_ROWS) -> DataFrame:
    """:func:`asof_join` when facts and starts are rows of ONE table (e.g.
    purchase and signup events): rows where ``is_start`` holds are starts,
    the others are facts, and the table is scanned once.  ``versions`` maps
    output names to expressions evaluated on the start row.  Returns the
    fact rows with ``fact_cols`` and the version columns."""
    start = F.coalesce(is_start, F.lit(False))
    # a start without key or time can never be found (as in asof_join)
    rows = df.where(~(start & (F.col(key).isNull() | F.col(ts).isNull())))
    u = rows.select(
        *dict.fromkeys([*fact_cols, key, ts]),
        F.when(start, 0).otherwise(1).alias(_KIND),
        F.when(start, F.col(tie)).alias(_TIE),
        F.when(start, _start_struct(F.col(ts), F.col(tie), versions)).alias(_EV),
    )
    return _asof(u, list(fact_cols), key, ts, list(versions), bucket, max_bucket_rows)


def _start_struct(t: Column, tie: Column, versions: dict[str, Column]) -> Column:
    # fields (time, tie, ...) so that max() picks the latest start
    return F.struct(t.alias("__t"), tie.alias("__k"),
                    *[c.alias(n) for n, c in versions.items()])


def _asof(u: DataFrame, fact_cols: Sequence[str], key: str, ts: str,
          version_cols: Sequence[str], bucket: Callable[[Column], Column] | None,
          max_bucket_rows: int | None) -> DataFrame:
    bucket = bucket or (lambda c: F.date_trunc("minute", c))
    b, sub, first_in, before = "__bucket", "__slice", "__in", "__before"
    # facts without key or time can match nothing: they bypass the windows
    # (a null key is a group of its own and may be huge), returned with nulls
    unmatched = F.col(key).isNull() | F.col(ts).isNull()
    ev_type = u.schema[_EV].dataType
    bypass = u.where(unmatched & (F.col(_KIND) == 1)).select(
        *fact_cols, *[F.lit(None).cast(ev_type[c].dataType).alias(c) for c in version_cols])
    u = u.where(~unmatched).withColumn(b, bucket(F.col(ts)))
    u = slice_hot_buckets(u, key, ts, b, sub, max_bucket_rows)
    # one row per (key, bucket, slice): its latest start (max compares __t,
    # then __k), partially aggregated before its shuffle; then the latest
    # start of all EARLIER slices, a per-key window of one row per slice
    per_bucket = u.groupBy(key, b, sub).agg(F.max(_EV).alias("__last"))
    prior = (Window.partitionBy(key).orderBy(b, sub)
             .rowsBetween(Window.unboundedPreceding, -1))
    per_bucket = per_bucket.select(key, b, sub, F.max("__last").over(prior).alias(before))
    # the latest start so far inside the fact's own slice
    running = (Window.partitionBy(key, b, sub).orderBy(ts, _KIND, _TIE)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = u.withColumn(first_in, F.last(_EV, ignorenulls=True).over(running))
    out = (u.where(F.col(_KIND) == 1)
           .join(per_bucket, [key, b, sub], "left")
           .withColumn(_EV, F.coalesce(first_in, before)))
    out = out.select(*fact_cols, *[F.col(f"{_EV}.{c}").alias(c) for c in version_cols])
    return out.unionByName(bypass)
