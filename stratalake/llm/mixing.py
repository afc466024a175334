"""Mixing sources to target weights (operator 2).

Every document gets a hash-random key.  Within its source, documents are
range-sorted by that key, a distributed prefix sum gives the words before each
document, and the source is cut at its exact word budget; a budget beyond the
source's size starts another epoch over the same order.

Defined results: null text has size 0; a null source is a source of its own,
ordered last; repeated rows count once each; rows of size 0 take nothing; an
empty table gives no rows and targets of 0.  Columns of other names than
``doc_id``, ``text``, ``source`` pass through untouched in ``mix``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, buckets_for, hash_bucket, materialize, prepare, quoted, running_total, unused

WEIGHTS = (5, 2, 1)      # repeating, by the source's place in code point order
SHARE = 1.5              # of all words
MAX_EPOCHS = 2           # a target stops at so many times its source's size


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> the same with ``target``, in words.

    A source that reaches ``max_epochs`` times its size stops there and the
    rest is shared again by weight.  The fixed point has one level L with
    target = min(max_epochs * size, weight * L); L follows from prefix sums
    over the sources ordered by cap / weight.  One row per source is windowed.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    table = sizes.withColumn("__w", F.element_at(F.array(*[F.lit(w) for w in weights]),
                                                 (place % len(weights) + 1).cast("int")))
    table = table.withColumn("__cap", F.col("source_size") * max_epochs)
    by_level = Window.orderBy(F.col("__cap") / F.col("__w"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    table = (table
             .withColumn("__all", F.sum("source_size").over(everything))
             .withColumn("__before", F.coalesce(F.sum("__cap").over(
                 by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .withColumn("__rest", F.sum("__w").over(
                 by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
             .withColumn("__level", (F.lit(share) * F.col("__all") - F.col("__before")) / F.col("__rest")))
    level = F.max(F.when(F.col("__w") * F.col("__level") <= F.col("__cap"), F.col("__level"))).over(everything)
    return (table.withColumn("__l", level)
            .withColumn("target", F.least(F.col("__cap").cast("double"), F.coalesce(
                F.col("__w") * F.col("__l"), F.col("__cap").cast("double"))))
            .select("source", "source_size", "target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
        max_epochs: int = MAX_EPOCHS, seed: str = "mix") -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, key) per document, all of them.

    ``taken`` counts the words the mix takes from the document over all
    epochs; the last document of a source may be taken in part, so a source
    takes floor(target) words exactly.
    """
    prepare(docs.sparkSession)
    sized = materialize(docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
              ).alias("key")), "mix")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("__n"))
    most = sizes.agg(F.max("__n")).first()[0] or 0
    goal = targets(sizes.drop("__n"), weights, share, max_epochs)
    rows = sized.withColumn("__bucket", hash_bucket(F.col("key"), buckets_for(most)))
    rows = running_total(rows, ["source"], "__bucket", ["key", "doc_id", "size"], "size", "__before", goal)
    budget = F.floor("target")
    full = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    part = budget - full * F.col("source_size")
    cut = F.least(F.greatest(part - F.col("__before"), F.lit(0)), F.col("size"))
    return rows.select("doc_id", "source", "key", "size", "source_size", "target",
                       (full * F.col("size") + cut).cast("long").alias("taken"))


def take(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
         max_epochs: int = MAX_EPOCHS, seed: str = "mix") -> DataFrame:
    """The mixed corpus: the columns of ``docs``, one row per epoch that takes the document.

    The document at a source's cut keeps its first words up to the cut.  Rows
    that agree in doc_id, source and size share out their decisions, most
    words first, in the order of their texts' hashes.
    """
    decided = mix(docs, weights, share, max_epochs, seed)
    same, nth, piece = (unused(docs, c) for c in ("__same", "__nth", "__piece"))
    words, taken = (unused(docs, c) for c in ("__size", "__taken"))

    def alike(size):
        return F.concat_ws("\x1f", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                           F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")), size.cast("string"))

    def place(*order):
        return F.row_number().over(Window.partitionBy(same).orderBy(*order))

    chosen = (decided.withColumn(same, alike(F.col("size"))).withColumn(nth, place(F.desc("taken")))
              .select(same, nth, F.col("size").alias(words), F.col("taken").alias(taken)))
    rows = (docs.withColumn(same, alike(word_count(F.col("text"))))
            .withColumn(nth, place(F.xxhash64("text"))))
    rows = rows.join(chosen, [same, nth]).where(F.col(taken) > 0)
    whole = F.floor(F.col(taken) / F.col(words))
    rest = F.col(taken) - whole * F.col(words)
    # one row per whole epoch (-1) and one for the part, if any
    pieces = F.filter(F.concat(F.array_repeat(F.lit(-1).cast("long"), whole.cast("int")),
                               F.array(rest.cast("long"))), lambda n: n != 0)
    rows = rows.withColumn(piece, F.explode(pieces))
    head = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)),
                                F.lit(1), F.col(piece).cast("int")), "")
    rows = rows.withColumn("text", F.when(F.col(piece) < 0, F.col("text")).otherwise(head))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*[F.col(quoted(c)) for c in docs.columns])
