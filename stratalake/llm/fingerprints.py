"""Document fingerprints by invertible Bloom lookup sketches (operator 7), DataFrame operations only.

A text's paragraphs (lines; a long one in slices, the first short) are hashed
to 64-bit digests.  Each digest goes to one cell of each of three subtables; a
cell holds a count, the XOR of its digests and the XOR of their check sums.
Sketches of two texts subtract cell by cell, which cancels what they share.
Peeling then recovers the digests that differ: a cell of count 1 or -1 whose
check sum fits holds one digest, which is taken out of its other cells, and so
on.  A pair whose cells do not empty is tried again with eight times as many
cells.  The recovered digests give the exact Jaccard likeness of two sets.

The first sketch, as text, is a document's fingerprint.  Subtables are peeled
in turn: a digest has one cell in each, so no digest is taken out twice, and
every round is one aggregation on the rows' own partitions, without a shuffle.

Defined results: a null text is empty; an empty text has the empty
fingerprint, and two of them have likeness 1; repeated paragraphs count once;
rows of equal doc_id are ordered by text, rows without doc_id come last; a
table of one row has itself as its next document; an empty table gives no
rows.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, prepare

TABLES = 3
CELLS = 12               # of a fingerprint
GROWTH = 8               # more cells at each retry
ROUNDS = 5               # times each subtable is peeled before a retry
#: First slice of a paragraph and the later ones, in code points.
FIRST, LATER = 32, 128
ROWS_PER_RANGE = 256


def digests(text: Column, first: int = FIRST, later: int = LATER) -> Column:
    """Distinct digests of a text's paragraphs."""
    pieces = F.regexp_extract_all(text, F.lit(rf"(?m)^[^\n]{{1,{first}}}|[^\n]{{1,{later}}}"), F.lit(0))
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p)))


def check_sum(digest: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(digest, F.lit("check")), 32)


def place(digest: Column, table: int, cells: int) -> Column:
    """The cell of a digest in one subtable, numbered over all subtables."""
    per = cells // TABLES
    return (F.pmod(F.xxhash64(digest, F.lit(table)), F.lit(per)) + table * per).cast("int")


def sketch_cells(sets: DataFrame, keys: list[str], digest: str, cells: int) -> DataFrame:
    """One row per digest -> (keys, cell, n, k, c) of the cells in use."""
    placed = sets.select(*keys, F.col(digest).alias("k"), check_sum(F.col(digest)).alias("c"), F.explode(
        F.array(*[place(F.col(digest), t, cells) for t in range(TABLES)])).alias("cell"))
    return placed.groupBy(*keys, "cell").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("k").alias("k"),
                                             F.bit_xor("c").alias("c"))


def peel(difference: DataFrame, keys: list[str], cells: int, rounds: int = ROUNDS) -> DataFrame:
    """Cells of subtracted sketches -> (keys, only_left, only_right, failed) of the pairs that differ.

    Recovered digests are counted in cells -1 (only in the first text) and -2.
    """
    now = difference.where("n <> 0 or k <> 0 or c <> 0")
    per = cells // TABLES

    def cell(at, n, k, c):
        return F.struct(at.cast("int").alias("cell"), n.cast("long").alias("n"), k.cast("long").alias("k"),
                        c.cast("long").alias("c"))

    zero = F.lit(0)
    for step in range(rounds * TABLES):
        table = step % TABLES
        n, k, c = F.col("n"), F.col("k"), F.col("c")
        pure = ((F.col("cell") >= 0) & (F.floor(F.col("cell") / per) == table) & (F.abs(n) == 1)
                & (check_sum(k) == c) & (place(k, table, cells) == F.col("cell")))
        taken = [cell(F.when(n > 0, -1).otherwise(-2), F.lit(1), zero, zero)]
        taken += [cell(place(k, t, cells), -n, k, c) for t in range(TABLES) if t != table]
        now = (now.withColumn("__out", F.explode(F.when(pure, F.array(*taken))
                                                 .otherwise(F.array(cell(F.col("cell"), n, k, c)))))
               .select(*keys, "__out.*").groupBy(*keys, "cell")
               .agg(F.sum("n").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("c").alias("c"))
               .where("n <> 0 or k <> 0 or c <> 0"))
    return now.groupBy(*keys).agg(
        F.sum(F.when(F.col("cell") == -1, F.col("n")).otherwise(0)).alias("only_left"),
        F.sum(F.when(F.col("cell") == -2, F.col("n")).otherwise(0)).alias("only_right"),
        F.max(F.col("cell") >= 0).alias("failed"))


def likeness(n_left: Column, n_right: Column, only_left: Column, only_right: Column) -> Column:
    """Jaccard likeness from set sizes and recovered differences."""
    return F.when(n_left + n_right == 0, F.lit(1.0)).otherwise((n_left - only_left) / (n_left + only_right))


def _tagged(name: str) -> Column:
    """The digests of one version, each with the version's name."""
    return F.transform(name, lambda d: F.struct(F.lit(name).alias("v"), d.alias("d")))


def compare(rows: DataFrame, keys: list[str], versions: list[str], cells: int = CELLS) -> DataFrame:
    """Likeness of each row's digest set ``base`` to each of ``versions``, by sketches that grow until all are peeled.

    ``rows``: keys, ``base`` and the version columns, arrays of distinct
    digests.  Returns keys, version, near.  A pair of n digests needs about
    1.3 n cells, so the retries end when the cells outgrow the largest text.
    """
    done: list[DataFrame] = []
    todo = rows.select(*keys, F.array(*[F.lit(v) for v in versions]).alias("__todo"))
    while True:
        source = rows if not done else rows.join(todo, keys)
        if not done:
            source = source.withColumn("__todo", F.array(*[F.lit(v) for v in versions]))
        source = source.repartition(*keys)
        tagged = F.concat(_tagged("base"), *[
            F.when(F.array_contains("__todo", v), _tagged(v)).otherwise(F.slice(_tagged(v), 1, 0)) for v in versions])
        sets = (source.select(*keys, "__todo", F.explode(tagged).alias("__t"))
                .select(*keys, "__todo", "__t.v", "__t.d"))
        cut = sketch_cells(sets, [*keys, "__todo", "v"], "d", cells)
        # subtract: the base enters every pair, a version only its own, negatively
        pair = F.when(F.col("v") == "base", F.col("__todo")).otherwise(F.array("v"))
        signed = cut.withColumn("n", F.when(F.col("v") == "base", F.col("n")).otherwise(-F.col("n")))
        difference = (signed.select(*keys, F.explode(pair).alias("version"), "cell", "n", "k", "c")
                      .groupBy(*keys, "version", "cell")
                      .agg(F.sum("n").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("c").alias("c")))
        found = materialize(peel(difference, [*keys, "version"], cells), "peeled")
        done.append(found.where("not failed"))
        failed = found.where("failed")
        if failed.isEmpty():
            break
        todo = failed.groupBy(*keys).agg(F.collect_set("version").alias("__todo"))
        cells *= GROWTH
    peeled = done[0]
    for more in done[1:]:
        peeled = peeled.unionByName(more)
    return peeled.select(*keys, "version", "only_left", "only_right")


def fingerprint(rows: DataFrame, keys: list[str], sets: str, out: str, cells: int = CELLS) -> DataFrame:
    """(keys, out): the sketch of the digest set ``sets`` as text; rows without digests are left out."""
    one = rows.select(*keys, F.explode(sets).alias("d"))
    cut = sketch_cells(one, keys, "d", cells)
    shown = F.concat_ws(":", "cell", "n", F.lower(F.hex("k")), F.lower(F.hex("c")))
    return cut.groupBy(*keys).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("cell", shown.alias("s")))), lambda x: x["s"]), " ").alias(out))


def next_documents(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(part, row, doc_id, text, base, next_text, next_base): each document with the next one by descending doc_id.

    Ids are cut into ranges; inside a range the next row is the window's next
    one, and a range's last row takes the first row of the next range in use.
    After the last document comes the first.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    least, most, n = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    least, most = least or 0, most or 0
    # in doubles, which keep the order of ids however far apart they lie
    width = float(max(1, (most - least + 1) * rows_per_range // max(1, n)))
    docs = docs.withColumn("part", F.coalesce(F.floor((F.col("doc_id").cast("double") - float(least)) / width),
                                              F.lit(-1)).cast("long"))
    docs = docs.withColumn("base", digests(F.col("text")))
    heads = materialize(docs.groupBy("part").agg(F.max(F.struct("doc_id", "text", "base")).alias("head")), "heads")
    # the next range in use: within groups of ranges, then between the groups' first ranges
    block = F.floor(F.col("part") / 1024)
    parts = heads.select("part", block.alias("block"))
    inside = parts.withColumn("after", F.lead("part").over(Window.partitionBy("block").orderBy(F.desc("part"))))
    tops = parts.groupBy("block").agg(F.max("part").alias("top"))
    every = Window.orderBy(F.desc("block"))
    tops = tops.withColumn("below", F.coalesce(F.lead("top").over(every), F.first("top").over(every)))
    after = (inside.join(tops, "block").select("part", F.coalesce("after", "below").alias("after")))
    heads = after.join(heads.select(F.col("part").alias("after"), F.col("head.text").alias("__text"),
                                    F.col("head.base").alias("__base")), "after").drop("after")
    order = Window.partitionBy("part").orderBy(F.col("doc_id").desc_nulls_last(), F.desc("text"))
    rows = (docs.withColumn("row", F.row_number().over(order))
            .withColumn("__next", F.lead(F.struct("text", "base")).over(order)))
    return (rows.join(heads, "part")
            .withColumn("next_text", F.coalesce("__next.text", "__text"))
            .withColumn("next_base", F.when(F.col("__next").isNotNull(), F.col("__next.base"))
                        .otherwise(F.col("__base"))).drop("__next", "__text", "__base"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness to each other and to the next document.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)
    """
    prepare(docs.sparkSession)
    rows = next_documents(docs)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = materialize(
        rows.withColumn("n_chars", n.cast("long")).withColumn("__edited", edited)
        .select("part", "row", "doc_id", "n_chars", F.sha2("__edited", 256).alias("edited_sha256"), "base",
                digests(F.col("__edited")).alias("edited"), F.col("next_base").alias("next")), "versions")
    keys = ["part", "row"]
    near = compare(rows, keys, ["edited", "next"])
    near = near.groupBy(*keys).agg(*[
        F.max(F.when(F.col("version") == v, F.col(side))).alias(f"{v}_{side}")
        for v in ("edited", "next") for side in ("only_left", "only_right")])
    out = rows.select(*keys, "doc_id", "n_chars", "edited_sha256", *[F.size(c).alias(f"__{c}")
                                                                    for c in ("base", "edited", "next")])
    spread = rows.select(*keys, "base", "edited").repartition(*keys)
    out = out.join(fingerprint(spread, keys, "base", "fingerprint"), keys, "left")
    out = out.join(fingerprint(spread, keys, "edited", "edited_fingerprint"), keys, "left")
    out = out.join(near, keys, "left")

    def like(v):
        lost = [F.coalesce(f"{v}_only_left", F.lit(0)), F.coalesce(f"{v}_only_right", F.lit(0))]
        return likeness(F.col("__base"), F.col(f"__{v}"), *lost)

    return out.select("doc_id", "n_chars", "edited_sha256", F.coalesce("fingerprint", F.lit("")).alias("fingerprint"),
                      F.coalesce("edited_fingerprint", F.lit("")).alias("edited_fingerprint"),
                      like("edited").alias("near_edited"), like("next").alias("near_next"))
