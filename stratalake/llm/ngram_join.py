"""N-gram Jaccard self-join by MinHash banding (operator 6).

A document is its set of n-grams of ``N`` words (all of its words, if fewer).
Documents of equal sets are one class.  ``BANDS`` bands of ``ROWS`` minima
give a pair of similarity 0.8 a chance of (1 - 0.8^5)^32 = 3e-6 of sharing no
band.  Classes are shuffled on band hashes; a bucket's smallest class is its
hub, and every pair of a bucket meets under that hub.  The classes under a hub
are cut into blocks, each pair of blocks is one group, and a group verifies
its pairs on the full n-gram sets by blocked matrix products: it returns for
each class the number of documents linked, and a spanning forest of its links,
never the pairs themselves.  A pair that meets under several hubs counts under
the smallest one they share.

Defined results: a null or empty text has no n-grams, no links and is a class
of its own; repeated rows are copies of each other; equal sets link (similarity
1); a null doc_id is kept and never names a class that has another; an empty
table gives no rows; extra columns are ignored.  ``keep_one`` tells rows apart
by doc_id and text, so an id with several texts, and texts without id, keep one
row in each class they are in; rows equal in both are one document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, materialize, prepare, quoted, unused
from .components import connected_components

N = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 5
BLOCK = 256              # classes of a block

_WORD = re.compile(WORD)
_MASK = np.uint64(0xFFFFFFFF)
_seeds = np.random.default_rng(20240607)
_A = _seeds.integers(1, 1 << 31, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _seeds.integers(0, 1 << 62, BANDS * ROWS, dtype=np.uint64)


def shingles(text: str | None, n: int = N) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of a whole text."""
    words = _WORD.findall(text or "")
    if not words:
        return np.empty(0, np.uint64)
    one = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "replace")) for w in words), np.uint64, len(words))
    k = min(n, len(words))
    h = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        h = (h ^ one[i:len(words) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    return np.unique(h)


def band_hashes(grams: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each band; bands of different places never collide by place."""
    least = np.full(BANDS * ROWS, _MASK, np.uint64)
    for a in range(0, len(grams), 4096):  # bounded memory on very long texts
        part = grams[a:a + 4096]
        for i in range(0, BANDS * ROWS, 16):
            mixed = part[:, None] * _A[i:i + 16] + _B[i:i + 16]
            least[i:i + 16] = np.minimum(least[i:i + 16], (mixed >> np.uint64(32)).min(axis=0))
    rows = least.reshape(BANDS, ROWS)
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        h = (h ^ rows[:, r]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def row_key() -> Column:
    """Digest of doc_id and text, never null: rows of equal key are copies of one document."""
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")), F.lit("|"),
                          F.coalesce(F.concat(F.lit("|"), F.col("text")), F.lit(""))).cast("binary"))


def _signed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, class, bands): class is a digest of the n-gram set, null without n-grams."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, key, text in zip(pdf["doc_id"], pdf["key"], pdf["text"]):
                grams = shingles(text)
                if len(grams):
                    out.append((doc_id, key, _class_of(grams), band_hashes(grams)))
                else:
                    out.append((doc_id, key, None, None))
            yield pd.DataFrame(out, columns=["doc_id", "key", "class", "bands"]).astype({"doc_id": "Int64"})

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), "text")
            .mapInPandas(run, "doc_id long, key string, class string, bands array<long>"))


def _block_pairs(members: DataFrame, grams: DataFrame, block: int) -> DataFrame:
    """(hub, class) and (class, n_docs, hubs, grams) -> one row per class and pair of blocks under a hub."""
    sizes = members.groupBy("hub").agg(F.count(F.lit(1)).alias("__n"))
    rows = (members.join(sizes, "hub").withColumn("__k", F.ceil(F.col("__n") / block).cast("int"))
            .withColumn("__mine", F.pmod(F.xxhash64("class"), F.col("__k")).cast("int")))
    rows = rows.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__k") - 1)))
    rows = rows.select("hub", F.least("__mine", "__other").alias("a"), F.greatest("__mine", "__other").alias("b"),
                       (F.col("__mine") > F.col("__other")).alias("second"), "class")
    return (rows.join(grams, "class").repartition("hub", "a", "b")
            .sortWithinPartitions("hub", "a", "b", "second", "class"))


def _verify(threshold: float):
    """Verify the sorted rows of whole block pairs."""

    def check(group: list[tuple]) -> list[tuple]:
        hub = group[0][0]
        names = [r[4] for r in group]
        second = np.array([r[3] for r in group])
        square = group[0][1] == group[0][2]
        docs = np.array([r[5] for r in group], np.int64)
        n = len(group)
        sets = [np.frombuffer(r[7], np.uint64) for r in group]
        sizes = np.array([len(s) for s in sets])
        wanted = np.triu(np.ones((n, n), bool), 1)
        if not square:
            wanted &= second[:, None] != second[None, :]
        # a pair that also meets under a smaller hub counts there
        smaller = sorted({h for r in group for h in r[6] if h < hub})
        if smaller:
            place = {h: i for i, h in enumerate(smaller)}
            met = np.zeros((n, len(smaller)), np.float32)
            for i, r in enumerate(group):
                met[i, [place[h] for h in r[6] if h < hub]] = 1
            wanted &= (met @ met.T) == 0
        wanted &= np.minimum.outer(sizes, sizes) >= threshold * np.maximum.outer(sizes, sizes) - 1e-9
        if not wanted.any():
            return []
        used = np.flatnonzero(wanted.any(0) | wanted.any(1))
        shared = np.zeros((n, n), np.float32)
        grams, column = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True)
        row = np.repeat(np.arange(len(used)), sizes[used])
        often = np.bincount(column, minlength=len(grams)) > 1
        keep = often[column]
        column, row = (np.cumsum(often) - 1)[column[keep]], row[keep]
        order = np.argsort(column, kind="stable")
        column, row = column[order], row[order]
        total = np.zeros((len(used), len(used)), np.float32)
        step = 4096
        for lo in range(0, int(often.sum()), step):
            i, j = np.searchsorted(column, [lo, lo + step])
            part = np.zeros((len(used), step), np.float32)
            part[row[i:j], column[i:j] - lo] = 1
            total += part @ part.T
        shared[np.ix_(used, used)] = total
        union = sizes[:, None] + sizes[None, :] - shared
        linked = wanted & (shared >= threshold * union - 1e-6)
        out = []
        both = linked | linked.T
        counts = both @ docs
        out += [(names[i], names[i], int(counts[i])) for i in np.flatnonzero(counts)]
        seen = np.zeros(n, bool)
        for s in range(n):  # a spanning forest of the links
            if seen[s]:
                continue
            seen[s] = True
            todo = [s]
            while todo:
                u = todo.pop()
                for v in np.flatnonzero(both[u] & ~seen):
                    seen[v] = True
                    out.append((names[u], names[v], 0))
                    todo.append(v)
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["hub", "a", "b", "second", "class", "n_docs", "hubs", "grams"]
        group: list[tuple] = []
        out: list[tuple] = []
        for pdf in batches:
            for r in pdf[names].itertuples(index=False, name=None):
                if group and group[0][:3] != r[:3]:
                    out += check(group)
                    group = []
                group.append(r)
            if len(out) > 4096:
                yield pd.DataFrame(out, columns=["src", "dst", "n_links"])
                out = []
        if group:
            out += check(group)
        yield pd.DataFrame(out, columns=["src", "dst", "n_links"])

    return run


def _class_of(grams: np.ndarray) -> str | None:
    return xxhash.xxh3_128_hexdigest(grams.tobytes()) if len(grams) else None


def _grams(texts: DataFrame) -> DataFrame:
    """(class, grams) of each text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = [shingles(t) for t in pdf["text"]]
            yield pd.DataFrame({"class": [_class_of(g) for g in sets], "grams": [g.tobytes() for g in sets]})

    return texts.mapInPandas(run, "class string, grams binary")


def links(docs: DataFrame, threshold: float = SIMILARITY, block: int = BLOCK
          ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents: doc_id, key, class), (classes: class, n_docs, least, first), (links: src, dst, n_links).

    ``first`` orders the documents of a class: by doc_id, those without id
    last, then by key.  A links row with src = dst adds n_links documents to that class's count;
    the others are links of a spanning forest of the classes.
    """
    prepare(docs.sparkSession)
    signed = materialize(_signed(docs), "signed")
    classes = materialize(signed.where("class is not null").groupBy("class").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("least"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("first"),
        F.first("bands").alias("bands")), "classes")
    banded = classes.select("class", F.explode("bands").alias("band"))
    hubs = (banded.groupBy("band").agg(F.min("class").alias("hub"), F.count(F.lit(1)).alias("__n"))
            .where("__n > 1").select("band", "hub"))
    members = materialize(banded.join(hubs, "band").select("hub", "class").distinct(), "members")
    # n-grams of the classes that met another, made again from one document of each
    met = materialize(members.groupBy("class").agg(F.collect_set("hub").alias("hubs"))
                      .join(classes.select("class", "n_docs", "first"), "class"), "met")
    keys = met.select(F.col("first.key").alias("__key"))
    # the keys grow with the input: merged at every size, never broadcast
    texts = docs.select("text", row_key().alias("__key")).join(keys.hint("merge"), "__key").select("text")
    grams = (_grams(texts).join(met.select("class", "n_docs", "hubs"), "class").groupBy("class")
             .agg(F.first("n_docs").alias("n_docs"), F.first("hubs").alias("hubs"), F.first("grams").alias("grams")))
    grams = materialize(grams, "grams")
    found = _block_pairs(members, grams, block).mapInPandas(
        _verify(threshold), "src string, dst string, n_links long")
    return signed.select("doc_id", "key", "class"), classes.drop("bands"), materialize(found, "links")


def _components(classes: DataFrame, found: DataFrame) -> DataFrame:
    """``classes`` with the ``component`` of classes that links connect."""
    parts = connected_components(found.select("src", "dst").where("src <> dst"))
    return (classes.join(parts.withColumnRenamed("node", "class"), "class", "left")
            .withColumn("component", F.coalesce("component", "class")))


def near_duplicates(docs: DataFrame, threshold: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """(doc_id, class_id, n_links) per document.

    ``class_id`` is the smallest doc_id among the documents connected by
    links; ``n_links`` counts the other documents whose similarity reaches
    ``threshold``.
    """
    signed, classes, found = links(docs, threshold, block)
    counts = found.where("src = dst").groupBy(F.col("src").alias("class")).agg(F.sum("n_links").alias("__links"))
    parts = materialize(_components(classes, found).join(counts, "class", "left")
                        .select("class", "least", "component",
                                (F.coalesce("__links", F.lit(0)) + F.col("n_docs") - 1).alias("n_links")), "parts")
    ids = parts.groupBy("component").agg(F.min("least").alias("class_id"))
    table = parts.join(ids, "component").select(F.col("class").alias("__class"), "class_id", "n_links")
    return (signed.join(table, F.col("class") == F.col("__class"), "left")
            .select("doc_id", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
                    .alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def keep_one(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each connected class: its first by doc_id (no id last) and text digest."""
    signed, classes, found = links(docs, threshold)
    named = _components(classes, found).groupBy("component").agg(F.min("first").alias("first")).select("first.key")
    alone = signed.where("class is null").select("key").distinct()
    own, place = unused(docs, "__key"), unused(docs, "__first")
    keys = materialize(named.unionByName(alone).withColumnRenamed("key", own), "kept-keys")
    kept = docs.withColumn(own, row_key()).join(keys, own, "left_semi")
    # copies may differ in other columns
    others = F.struct(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"]).cast("string")
    first = F.row_number().over(Window.partitionBy(own).orderBy(F.xxhash64(others)))
    return kept.withColumn(place, first).where(F.col(place) == 1).select(*[F.col(quoted(c)) for c in docs.columns])
