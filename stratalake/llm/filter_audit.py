"""Filter interaction audit by exact constrained least squares (operator 12).

Five filters fail documents; what each removes depends on those before it.
Instead of running orders, the audit tabulates for each of the 32 coalitions of
filters how many documents it removes.  Everything follows from these counts:
a step removes the difference between two coalitions, and a filter's Shapley
value is its coefficient in the weighted least-squares fit of the coalition
counts that spends exactly the removals of all five.  The normal equations of
that fit are solved in rationals, so 120 times a coefficient is a whole number.

Filter E (a text equal to one of a smaller id) needs other documents: whole
texts are compared by SHA-256, and rows are ranked by id within a digest, which
Spark cuts to the first ids of each map task before its shuffle.  Rows repeated
with one id are counted, not listed, before any key is grouped by; labels meet
one row for each id, part and failure mask, so neither a hot text, nor a hot id,
nor a third of rows without one gathers in a task.

Defined results: a null text is empty and a null source the part ''; a null
id is not smaller than any, never fails E and has no label; rows repeated with
one id are all counted, and do not fail E by each other; of several labels of
an id the larger counts; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, prepare

FILTERS = "ABCDE"
LEAST_WORDS = 200
SYMBOLS = b"#$%&*|"
_CAPITALS = bytes(range(65, 91))
_CONTINUATION = bytes(range(128, 192))
#: The counts of a coalition: documents, those of good quality, those that are toxic.
MEASURES = ("n", "good", "toxic")


def failures(text: bytes) -> int:
    """Bits of the filters A to D that a UTF-8 text fails."""
    words = text.split()  # bytes split at space and \\x09-\\x0d only
    code_points = len(text.translate(None, _CONTINUATION))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (1 * (len(words) < LEAST_WORDS) | 2 * (2 * len(set(words)) < len(words))
            | 4 * (100 * capitals > 2 * code_points) | 8 * (len(text.translate(None, SYMBOLS)) < len(text)))


def checked(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, digest) of every document; the mask is that of the whole text without E."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), pa.array([failures(t) for t in texts], pa.int32()),
                 pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())],
                names=["doc_id", "part", "mask", "digest"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, part string, mask int, digest binary")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by all filters that they fail."""
    rows = materialize(checked(docs).groupBy("doc_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n")),
                       "checked")
    by_id = Window.partitionBy("digest").orderBy("doc_id")
    first = (rows.where(F.col("doc_id").isNotNull()).withColumn("__nth", F.rank().over(by_id))
             .where(F.col("__nth") == 1))
    # every row as a copy, and first ones moved from the copies to the rest
    names = ["doc_id", "part", "mask"]
    zero = F.lit(0).cast("long")
    copies = rows.select(*names, F.when(F.col("doc_id").isNull(), zero).otherwise(F.col("n")).alias("copy"),
                         F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(zero).alias("own"))
    own = first.select(*names, (-F.col("n")).alias("copy"), F.col("n").alias("own"))
    each = copies.unionByName(own).groupBy(*names).agg(F.sum("copy").alias("copy"), F.sum("own").alias("own"))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("long")), zero).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("long")), zero).alias("toxic"))
    each = each.join(marks, "doc_id", "left")
    both = F.explode(F.array(F.struct(F.col("mask").alias("mask"), F.col("own").alias("n")),
                             F.struct((F.col("mask") + 16).alias("mask"), F.col("copy").alias("n")))).alias("__c")
    count = lambda c: F.sum(F.col("__c.n") * F.coalesce(F.col(c), zero)).alias(c)
    return (each.select("part", "good", "toxic", both).where(F.col("__c.n") != 0)
            .groupBy("part", F.col("__c.mask").alias("mask"))
            .agg(F.sum("__c.n").alias("n"), count("good"), count("toxic")))


def solve(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """The exact solution of a square system, by elimination."""
    rows = [[*r, b] for r, b in zip(matrix, right)]
    n = len(rows)
    for i in range(n):
        pivot = next(k for k in range(i, n) if rows[k][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [v / rows[i][i] for v in rows[i]]
        for k in range(n):
            if k != i and rows[k][i]:
                rows[k] = [a - rows[k][i] * b for a, b in zip(rows[k], rows[i])]
    return [r[-1] for r in rows]


def shapley(removed: list[int], n: int) -> list[Fraction]:
    """Shapley values from the coalitions' counts, ``removed[bits]``.

    Least squares of removed[S] on the members of S, S neither empty nor full,
    weighted by the Shapley kernel; a Lagrange multiplier makes the values add
    up to the removals of all filters.
    """
    full = (1 << n) - 1
    matrix = [[Fraction(0)] * (n + 1) for _ in range(n + 1)]
    right = [Fraction(0)] * (n + 1)
    for coalition in range(1, full):
        size = coalition.bit_count()
        weight = Fraction(n - 1, comb(n, size) * size * (n - size))
        members = [i for i in range(n) if coalition >> i & 1]
        for i in members:
            right[i] += weight * removed[coalition]
            for j in members:
                matrix[i][j] += weight
    for i in range(n):
        matrix[i][n] = matrix[n][i] = Fraction(1)
    right[n] = Fraction(removed[full])
    return solve(matrix, right)[:n]


def coalition_table(masks: dict[int, int], n: int) -> list[int]:
    """For each coalition, the documents that fail any of its filters."""
    return [sum(v for mask, v in masks.items() if mask & coalition) for coalition in range(1 << n)]


def interactions(counts: dict[str, dict[int, int]], filters: str = FILTERS) -> list[dict]:
    """One row per order and step, from documents by failure mask of each measure."""
    n = len(filters)
    full = (1 << n) - 1
    total = sum(counts["n"].values())
    removed = {m: coalition_table(counts[m], n) for m in MEASURES}
    values = [int(v * factorial(n)) for v in shapley(removed["n"], n)]
    out = []
    for order in permutations(range(n)):
        before = 0
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            here = {m: removed[m][after] - removed[m][before] for m in MEASURES}
            out.append({"filter_order": "".join(filters[i] for i in order), "step": step,
                        "kept": total - removed["n"][after], "removed": here["n"],
                        "redundant": removed["n"][1 << f] - here["n"],
                        "unique_fails": removed["n"][full] - removed["n"][full ^ 1 << f],
                        "good_lost": here["good"], "toxic_lost": here["toxic"], "shapley": values[f]})
            before = after
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every part, order and step with what the step keeps, removes and shares with other filters.

    A part brings at most 32 rows, one for each failure mask, to its task.
    """
    prepare(docs.sparkSession)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = {m: dict(zip(pdf["mask"].tolist(), pdf[m].tolist())) for m in MEASURES}
        out = pd.DataFrame(interactions(counts))
        out.insert(0, "part", pdf["part"].iloc[0])
        return out

    return mask_counts(docs, labels).groupBy("part").applyInPandas(
        run, "part string, filter_order string, step int, kept long, removed long, redundant long, "
             "unique_fails long, good_lost long, toxic_lost long, shapley long")
