"""Language-model scoring with a log-frequency Bloom filter (operator 13).

The counts of all n-grams of the training texts are quantised to the number of
their binary digits, q.  A Bloom filter takes the keys (n-gram, 1) to
(n-gram, q), so an n-gram's quantised count is found again by asking for level
1, 2, ... until one is missing.  Answers are never too low; about one unseen
n-gram in a hundred is taken for a seen one, an error in one direction only.

The filter grows with the corpus: it consists of slices by n-gram hash, each
built in one task from the n-gram counts that all tasks send for it.  Workers
get it by broadcast in rounds of whole slices, at most ``ROUND_BYTES`` at a
time (checked before a round is built).  A round reads the texts once and
writes, for every document, the levels of those of its n-grams that lie in the
round's slices; the largest level of each position over all rounds is the
filter's answer, and a probability is smoothed from the answers of its n-gram,
its history and the lower orders:

    p(w)          = (c(w) + 1) / (N + V + 1)
    p(w | h v..)  = (c(h w) + MU * p(w | shorter history)) / (c(h) + MU)

The base score needs exact counts.  Words are counted exactly; the frequent
ones, at most ``HEAD_WORDS``, are broadcast, and the others of a document meet
their count in a join, where no word can be hot: each is rarer than all of more
than ``HEAD_WORDS`` words.

Defined results: a null text is empty, its only token is the end; repeated rows
are scored alike and returned each; without a training row all counts are 0; an
empty table gives no rows; extra columns are ignored.  Documents are told apart
by id and text, so null and repeated ids do no harm.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, prepare

ORDER = 2
#: Weight of the shorter history, in counts: of 1 to 10,000 the best on rows of crc32 mod 7 = 3, learned from 0, 1, 4, 5, 6.
MU = 2000.0
#: Bits of the filter for each of its keys, and probes of each key: about 1 % false answers.
BITS, PROBES = 10, 6
#: N-gram occurrences that one slice of the filter is meant for.
SLICE_GRAMS = 1 << 17
ROUND_BYTES = 64 << 20
HEAD_WORDS = 1 << 17
#: N-grams that a task gathers before it sends them on.
GATHER = 1 << 21

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
END, START = b"", b" "  # neither can be a word


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed scramble of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@dataclass
class Tokens:
    """The words of a batch: ``codes`` into ``words``, those of document i from ``begin[i]`` on."""
    words: list[bytes]
    codes: np.ndarray
    begin: np.ndarray


def tokens(texts: pa.Array) -> Tokens:
    low = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    split = pc.ascii_split_whitespace(low)
    flat = split.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    offsets = split.offsets.to_numpy()
    coded = flat.filter(full).cast(pa.large_binary()).dictionary_encode()
    return Tokens(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64),
                  before[offsets - offsets[0]])


def positions(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(codes, first position of each document and the end).

    A document's positions are a start mark, its words and its end.  The end
    has the code after the words', the start mark the next one.
    """
    n = np.diff(t.begin)
    first = np.concatenate([[0], np.cumsum(n + 2)])
    codes = np.full(first[-1], len(t.words) + 1, np.int64)
    codes[first[1:] - 1] = len(t.words)
    codes[np.arange(len(t.codes)) + np.repeat(2 * np.arange(len(n)) + 1, n)] = t.codes
    return codes, first


def grams(t: Tokens, order: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """(codes, hash of each code, hashes[order - 2] at each position for orders from 2 on, first positions).

    The n-gram at a position ends there and is filled up with start marks.
    """
    import xxhash

    codes, first = positions(t)
    known = np.array([xxhash.xxh3_64_intdigest(w) for w in (*t.words, END, START)], np.uint64)
    single = mixed(known + _STEP)
    longer = []
    if order > 1:
        h, at, start = known[codes], np.arange(len(codes)), np.repeat(first[:-1], np.diff(first))
        back = [h] + [h[np.maximum(at - k, start)] for k in range(1, order)]
        for k in range(1, order):
            g = np.full(len(h), k + 1, np.uint64)
            for i in range(k, -1, -1):
                g = mixed(g * _STEP + back[i])
            longer.append(g)
    return codes, single, longer, first


def totals(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different hashes, ascending, with their summed counts."""
    if not len(hashes):
        return hashes, counts
    order = np.argsort(hashes)
    hashes = hashes[order]
    begin = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    return hashes[begin], np.add.reduceat(counts[order], begin)


def slice_of(hashes: np.ndarray, slices: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int64)


def level(counts: np.ndarray) -> np.ndarray:
    """Quantised count: the number of binary digits."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def estimate(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts that share a level."""
    return np.where(levels > 0, 1.5 * 2.0 ** (levels - 1.0) - 0.5, 0.0)


def probe(hashes: np.ndarray, lev: int, i: int, bits: np.ndarray) -> np.ndarray:
    """Bit number of probe i for the keys (hash, lev) in filters of ``bits`` bits."""
    a = mixed(hashes + np.uint64(lev * int(_STEP) % (1 << 64)))
    return (a + np.uint64(i) * (mixed(a) | np.uint64(1))) % bits


def build(hashes: np.ndarray, levels: np.ndarray, key_bits: int = BITS) -> bytes:
    """The filter of n-grams with their levels."""
    size = np.uint64(max(64, -(-int(levels.sum()) * key_bits // 64) * 64))
    bits = np.zeros(int(size), bool)
    for lev in range(1, int(levels.max(initial=0)) + 1):
        own = hashes[levels >= lev]
        for i in range(PROBES):
            bits[probe(own, lev, i, size)] = True
    return np.packbits(bits, bitorder="little").tobytes()


@dataclass
class Filters:
    """Slices ``low`` to ``low + len(sizes) - 1`` of ``slices``."""
    slices: int
    low: int
    sizes: np.ndarray    # bits of each slice
    begin: np.ndarray    # its first byte
    data: np.ndarray

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """The level found for each hash; 0 outside these slices."""
        out = np.zeros(len(hashes), np.uint8)
        own = slice_of(hashes, self.slices) - self.low
        live = np.flatnonzero((own >= 0) & (own < len(self.sizes)))
        lev = 0
        while len(live):
            lev += 1
            for i in range(PROBES):
                s = own[live]
                bit = probe(hashes[live], lev, i, self.sizes[s])
                byte = self.data[self.begin[s] + (bit >> np.uint64(3)).astype(np.int64)]
                live = live[(byte >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1]
            out[live] = lev
        return out


@dataclass
class Model:
    words: DataFrame      # (word, train, every): exact counts in training rows and in all
    filters: DataFrame    # (slice, bits)
    tokens: int           # N
    types: int            # V
    slices: int
    least: int            # rank of frequency from which words belong to the head
    order: int


def _text() -> list[Column]:
    return [F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")]


def word_counts(docs: DataFrame, train: Column) -> DataFrame:
    """(word, train, every): exact counts of every token of the training rows and of all rows."""

    def merged(gathered: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        found = pa.Table.from_batches(gathered).group_by("word").aggregate([("train", "sum"), ("every", "sum")])
        return found.rename_columns(["word", "train", "every"]).combine_chunks().to_batches(max_chunksize=1 << 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0
        for batch in batches:
            t = tokens(batch.column("text"))
            own = batch.column("train").to_numpy(zero_copy_only=False)
            n = len(t.words)
            every = np.bincount(t.codes, minlength=n)
            inside = np.bincount(t.codes[np.repeat(own, np.diff(t.begin))], minlength=n)
            gathered.append(pa.RecordBatch.from_arrays(
                [pa.array([*t.words, END], pa.binary()), pa.array(np.append(inside, own.sum()), pa.int64()),
                 pa.array(np.append(every, len(own)), pa.int64())], names=["word", "train", "every"]))
            size += n
            if size >= GATHER >> 1:
                yield from merged(gathered)
                gathered, size = [], 0
        if gathered:
            yield from merged(gathered)

    rows = docs.select(*_text(), F.coalesce(train, F.lit(False)).alias("train")).drop("doc_id")
    return (rows.mapInArrow(run, "word binary, train long, every long").groupBy("word")
            .agg(F.sum("train").alias("train"), F.sum("every").alias("every")))


def frequency_rank() -> Column:
    """Words of one rank differ in frequency by less than a fifth."""
    return F.floor(F.log2(F.col("every").cast("double")) * 4).cast("int")


def gram_counts(texts: DataFrame, order: int, slices: int) -> DataFrame:
    """(slice, hashes, counts): what each task has counted, as packed arrays."""

    def packed(singles: list[tuple], longer: list[np.ndarray]) -> pa.RecordBatch:
        one = totals(*(np.concatenate(x) for x in zip(*singles)))
        more = np.unique(np.concatenate(longer), return_counts=True) if longer else (one[0][:0], one[1][:0])
        found, n = totals(*(np.concatenate(x) for x in zip(one, more)))  # sorted, so slices follow each other
        at = slice_of(found, slices)
        own, begin = np.unique(at, return_index=True)
        ends = [*begin[1:].tolist(), len(found)]
        n = n.astype("<u4")
        return pa.RecordBatch.from_arrays(
            [pa.array(own, pa.int64()),
             pa.array([found[a:b].tobytes() for a, b in zip(begin.tolist(), ends)], pa.binary()),
             pa.array([n[a:b].tobytes() for a, b in zip(begin.tolist(), ends)], pa.binary())],
            names=["slice", "hashes", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        singles, longer, size = [], [], 0
        for batch in batches:
            codes, single, more, _ = grams(tokens(batch.column("text")), order)
            singles.append((single, np.bincount(codes, minlength=len(single))))
            longer += more
            size += len(codes) * order
            if size >= GATHER:
                yield packed(singles, longer)
                singles, longer, size = [], [], 0
        if size:
            yield packed(singles, longer)

    return texts.select("text").mapInArrow(run, "slice long, hashes binary, counts binary")


def slice_filters(parts: DataFrame, key_bits: int) -> DataFrame:
    """(slice, bits): the filter of each slice, from all that the tasks counted for it."""

    def run(own: pa.Table) -> pa.Table:
        blobs = {c: b"".join(own.column(c).to_numpy()) for c in ("hashes", "counts")}
        hashes, counts = np.frombuffer(blobs["hashes"], np.uint64), np.frombuffer(blobs["counts"], "<u4")
        found, total = totals(hashes, counts.astype(np.int64))
        bits = build(found, level(total), key_bits)
        return pa.table({"slice": own.column("slice")[:1], "bits": pa.array([bits], pa.binary())})

    return parts.groupBy("slice").applyInArrow(run, "slice long, bits binary")


def fit(docs: DataFrame, train: Column, order: int = ORDER, key_bits: int = BITS) -> Model:
    """Exact word counts and the filter of all n-grams of the rows that ``train`` marks."""
    prepare(docs.sparkSession)
    words = materialize(word_counts(docs, train), "words")
    row = words.agg(F.coalesce(F.sum("train"), F.lit(0)).alias("n"), F.count_if(F.col("train") > 0).alias("v")).first()
    ranks = words.groupBy(frequency_rank().alias("rank")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, room = 1 << 30, HEAD_WORDS
    for r in sorted(ranks, key=lambda r: -r["rank"]):   # a few hundred ranks at most
        room -= r["n"]
        if room < 0:
            break
        least = r["rank"]
    slices = max(1, -(-row["n"] * order // SLICE_GRAMS))
    parts = gram_counts(docs.where(train).select(*_text()), order, slices)
    filters = materialize(slice_filters(parts, key_bits), "filters")
    return Model(words, filters, row["n"], row["v"], slices, least, order)


def rounds(model: Model, round_bytes: int = ROUND_BYTES) -> int:
    """The least number of equal ranges of slices found of which none exceeds ``round_bytes``."""
    sizes = model.filters.select("slice", F.length("bits").cast("long").alias("size"))
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    n = max(1, -(-total // round_bytes))
    while n < model.slices:
        worst = (sizes.groupBy(F.floor(F.col("slice") * n / model.slices)).agg(F.sum("size").alias("size"))
                 .agg(F.max("size")).first()[0])
        if worst <= round_bytes:
            break
        n += max(1, n // 16)
    return min(n, model.slices)


def round_filters(model: Model, i: int, n: int) -> Filters:
    """The slices of round i of n."""
    mine = [s for s in (-(-i * model.slices // n), -(-(i + 1) * model.slices // n))]
    rows = model.filters.where((F.col("slice") >= mine[0]) & (F.col("slice") < mine[1])).collect()
    held = {r["slice"]: r["bits"] for r in rows}
    blobs = [held.get(s, bytes(8)) for s in range(*mine)]
    size = np.array([len(b) for b in blobs], np.int64)
    return Filters(model.slices, mine[0], (size * 8).astype(np.uint64), np.concatenate([[0], np.cumsum(size)[:-1]]),
                   np.frombuffer(b"".join(blobs), np.uint8))


def digest(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


def digests(texts: pa.Array) -> pa.Array:
    return pa.array([digest(t) for t in texts.cast(pa.binary()).to_numpy(zero_copy_only=False)], pa.binary())


def found_levels(docs: DataFrame, model: Model, i: int, n: int) -> DataFrame:
    """(doc_id, digest, levels): for each document the levels that round i finds, by order and position."""
    held = docs.sparkSession.sparkContext.broadcast(round_filters(model, i, n))
    order = model.order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            codes, single, longer, first = grams(tokens(texts), order)
            filters = held.value
            levels = np.stack([filters.levels(single)[codes], *[filters.levels(h) for h in longer]])
            ends = first.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), digests(texts),
                 pa.array([levels[:, a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary())],
                names=["doc_id", "digest", "levels"])

    found = materialize(docs.select(*_text()).mapInArrow(run, "doc_id long, digest binary, levels binary"), "levels")
    held.destroy()
    return found


def log_probability(levels: np.ndarray, n: int, v: int) -> float:
    """log10 probability of a document from the levels [order, position] of its n-grams."""
    c = estimate(levels)
    p = np.minimum((c[0, 1:] + 1) / (n + v + 1), 1.0)
    for k in range(1, len(c)):
        p = (c[k, 1:] + MU * p) / (np.maximum(c[k - 1, :-1], c[k, 1:]) + MU)
    return float(np.log10(p).sum())


def model_scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, digest, copies, score) of every different document."""
    n = rounds(model)
    found = [found_levels(docs, model, i, n) for i in range(n)]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    # equal rows find equal levels, so copies merge before the shuffle
    each = every.groupBy("doc_id", "digest").agg((F.count(F.lit(1)) / n).cast("long").alias("copies"),
                                                 F.collect_set("levels").alias("levels"))
    total, types, order = model.tokens, model.types, model.order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = [log_probability(np.max([np.frombuffer(b, np.uint8).reshape(order, -1) for b in bs], axis=0),
                                     total, types) for bs in batch.column("levels").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(score, pa.float64())],
                                             names=["doc_id", "digest", "copies", "score"])

    return each.mapInArrow(run, "doc_id long, digest binary, copies long, score double")


def base_scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, digest, n_tokens, n_known, base_score) of every different document, from exact counts."""
    spark = docs.sparkSession
    frequent = model.words.where(frequency_rank() >= model.least).select("word", "train")
    head = spark.sparkContext.broadcast({bytes(r["word"]): r["train"] for r in frequent.collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = head.value
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column("text")
            t = tokens(texts)
            c = np.array([counts.get(w, -1) for w in (*t.words, END)], np.int64)
            logs = np.log10(np.maximum(c, 0) + 1.0)
            codes, first = positions(t)
            codes = np.where(codes > len(t.words), len(t.words), codes)
            mark = np.zeros(len(codes), bool)          # start marks are no tokens
            mark[first[:-1]] = True
            n = np.diff(first) - 1
            known = np.add.reduceat(((c[codes] > 0) & ~mark).astype(np.int64), first[:-1])
            sums = np.add.reduceat(np.where(mark, 0.0, logs[codes]), first[:-1])
            doc = np.repeat(np.arange(len(n)), n + 1)
            rare = np.flatnonzero((c[codes] < 0) & ~mark)
            # the rare words of each document and how often it has them
            pair, times = np.unique(doc[rare] * (len(t.words) + 1) + codes[rare], return_counts=True)
            cut = np.searchsorted(pair // (len(t.words) + 1), np.arange(len(n) + 1))
            words = [t.words[w] if w < len(t.words) else END for w in (pair % (len(t.words) + 1)).tolist()]
            lists = lambda v, kind: pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(v, kind))
            out = [pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(sums, pa.float64()),
                   lists(words, pa.binary()), lists(times, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), digests(texts), *out],
                names=["doc_id", "digest", "n_tokens", "known", "logs", "rare", "times"])

    rows = docs.select(*_text()).mapInArrow(
        run, "doc_id long, digest binary, n_tokens long, known long, logs double, rare array<binary>, times array<long>")
    key = ["doc_id", "digest"]
    rows = materialize(rows.groupBy(*key).agg(*[F.first(c).alias(c) for c in rows.columns if c not in key]), "known")
    rare = rows.select(*key, F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        *key, F.col("r.rare").alias("word"), F.col("r.times").alias("times"))
    rest = rare.join(model.words.where(frequency_rank() < model.least).select("word", "train"), "word")
    parts = rest.select(*key, (F.col("times") * F.log10(F.col("train") + 1.0)).alias("logs"),
                        F.when(F.col("train") > 0, F.col("times")).otherwise(0).alias("known"),
                        F.lit(0).cast("long").alias("n_tokens"))
    both = rows.select(*key, "logs", "known", "n_tokens").unionByName(parts)
    each = both.groupBy(*key).agg(*[F.sum(c).alias(c) for c in ("logs", "known", "n_tokens")])
    whole = F.lit(math.log10(model.tokens + model.types + 1))
    return each.select(*key, "n_tokens", F.col("known").alias("n_known"),
                       (F.col("logs") - F.col("n_tokens") * whole).alias("base_score"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score), one row for each row of ``docs``."""
    prepare(docs.sparkSession)
    a, b = model_scores(docs, model).alias("a"), base_scores(docs, model).alias("b")
    both = a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.digest") == F.col("b.digest")))
    return both.select("a.doc_id", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                       "base_score", "score", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("__copy")
                       ).drop("__copy")
