"""Best-fit packing by minimum bin slack (operator 9).

Documents become token ids and one end-of-document id; only documents longer
than a sequence are cut.  Packing depends on the lengths alone, so a histogram
of piece lengths (at most ``capacity`` rows, whatever the input) goes to the
driver.  There, bin by bin, the largest length left is the seed and a bitset
subset-sum over the other lengths finds the fullest feasible bin; that pattern
is removed as often as the histogram allows.  Each pattern takes a range of
ranks of each of its lengths, and the pieces, ranked within their length by a
distributed prefix sum, find sequence and offset by binary search in those
ranges.

Defined results: null text is empty (its only id is the end id); repeated rows
are packed once each; an empty table gives no rows; extra columns are ignored
by ``pack`` and carried by ``pack_rows``.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, hash_bucket, materialize, prepare, running_total

CAPACITY = 2048
END_ID = 0
TOKENIZER = "word_bpe_49k.json"
#: Words whose ids a worker keeps; the table starts anew beyond it (memory, not results).
CACHE_WORDS = 800_000

_STATE: dict = {}

#: Words that need no normalising beyond lower case: printable ASCII and Latin-1 letters.
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_MARK = "\ue000"  # closes a word; never part of a plain one


class PlainBpe:
    """The same merges run by tiktoken's faster loop, for plain words.

    A word's last symbol carries the end mark, which is merged to it first.
    tiktoken merges neighbours whenever their joined bytes are a token, the
    tokenizer only where it has that merge.  Both agree if every token's own
    symbols merge back to it, since then neighbours that make up a token
    always are its merge; that is checked for all merges when loading, and a
    tokenizer that fails it encodes all words itself.
    """

    def __init__(self, spec: dict):
        import regex
        import tiktoken

        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        vocab = spec["model"]["vocab"]
        merges = self.merges(spec)
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        letters = {b: chr(b) for b in shown}
        letters |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in letters)}
        byte = {c: b for b, c in letters.items()}
        mark = _MARK.encode()

        def raw(token: str) -> bytes:
            end = token.endswith("</w>")
            return bytes(byte[c] for c in (token[:-4] if end else token)) + (mark if end else b"")

        ranks = {mark[:2]: 0, mark: 1}
        ids = [0, 0]

        def add(key: bytes, token: str) -> None:
            if key not in ranks:
                ranks[key] = len(ids)
                ids.append(vocab[token])

        for b, c in letters.items():
            add(bytes([b]) + mark, c + "</w>")
        for a, b in merges:
            add(raw(a) + raw(b), a + b)
        for b, c in letters.items():
            add(bytes([b]), c)
        self.ids = np.array(ids, np.uint32)
        self.ends = np.zeros(len(ids), bool)
        for key, rank in ranks.items():
            self.ends[rank] = key.endswith(mark)
        self.bpe = tiktoken.Encoding("plain words", pat_str=f"[^{_MARK}]+{_MARK}", mergeable_ranks=ranks,
                                     special_tokens={})

    @staticmethod
    def merges(spec: dict) -> list[tuple[str, str]]:
        return [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]

    @staticmethod
    def consistent(merges: list[tuple[str, str]]) -> bool:
        rank = {m: i for i, m in enumerate(merges)}
        none = len(merges)
        for a, b in merges:
            token = a + b
            end = token.endswith("</w>")
            symbols = list(token[:-4] if end else token)
            if end:
                symbols[-1] += "</w>"
            while len(symbols) > 1:
                best, i = min((rank.get((symbols[i], symbols[i + 1]), none), i) for i in range(len(symbols) - 1))
                if best == none:
                    return False
                symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
        return True

    def encode(self, words: list[str]) -> list[np.ndarray]:
        parts = [self.pattern.findall(w.lower()) for w in words]
        out = np.array(self.bpe.encode_ordinary("".join(p + _MARK for ps in parts for p in ps)), np.int64)
        last = np.flatnonzero(self.ends[out]) + 1
        cuts = np.concatenate([[0], last])[np.cumsum([len(p) for p in parts])]
        return np.split(self.ids[out], cuts[:-1])


class WordEncoder:
    """Ids of texts by a tokenizer that drops white space and ends each word's last id by ``</w>``.

    White space separates words for certain, so every distinct stretch between
    spaces is encoded once and its ids are kept.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.plain = None
        if spec["model"].get("end_of_word_suffix") == "</w>" and PlainBpe.consistent(PlainBpe.merges(spec)):
            self.plain = PlainBpe(spec)
        self.special = tuple(t["content"] for t in spec["added_tokens"])
        self.reset()

    def _ids(self, words: list[str]) -> list[np.ndarray]:
        plain = [w for w in words if self.plain and _PLAIN.fullmatch(w) and not any(t in w for t in self.special)]
        known = dict(zip(plain, self.plain.encode(plain))) if plain else {}
        rest = [w for w in words if w not in known]
        if rest:
            known |= {w: np.array(c.ids, np.uint32) for w, c in
                      zip(rest, self.tok.encode_batch_fast(rest, add_special_tokens=False))}
        return [known[w] for w in words]

    def reset(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _learn(self, words: list[str]) -> None:
        coded = self._ids(words)
        n = len(self.index)
        while n + len(words) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        for w, ids in zip(words, coded):
            k = len(ids)
            while self.used + k > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.flat[self.used:self.used + k] = ids
            self.start[n], self.size[n] = self.used, k
            self.index[w] = n
            self.used += k
            n += 1

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one row, and where each text's begin (one more entry than texts).

        Every distinct stretch of a batch is looked up once; Arrow finds the distinct ones.
        """
        if len(self.index) > CACHE_WORDS:
            self.reset()
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        new = [w for w in words if w not in self.index]
        if new:
            self._learn(new)
        place = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        at = place[coded.indices.to_numpy()]
        size = self.size[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.arange(ends[-1]) + np.repeat(self.start[at] - ends[:-1], size)]
        offsets = split.offsets.to_numpy()
        return ids, ends[offsets - offsets[0]]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids, begin = self.encode_all(pa.array(texts, pa.large_string()))
        return np.split(ids, begin[1:-1])


def encoder(path: str) -> WordEncoder:
    if path not in _STATE:
        _STATE[path] = WordEncoder(path)
    return _STATE[path]


def fullest_bin(lengths: list[int], counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The bin of the largest length left that leaves least slack: {length: copies}.

    ``lengths`` descend.  A bit of ``reach`` is a sum that some combination
    makes; the sums before each item are kept to trace one combination back.
    """
    seed = lengths[0]
    room = capacity - seed
    reach, kept, items = 1, [], []
    full = 1 << room
    mask = (full << 1) - 1
    for length in lengths:
        if length > room:
            continue
        left = min(counts[length] - (length == seed), room // length)
        copies = 1
        while left > 0:
            k = min(copies, left)
            kept.append(reach)
            items.append((length, k))
            reach |= (reach << (length * k)) & mask
            left -= k
            copies *= 2
            if reach & full:
                break
        if reach & full:
            break
    total = reach.bit_length() - 1
    found = {seed: 1}
    for (length, k), before in zip(reversed(items), reversed(kept)):
        if not before >> total & 1:
            found[length] = found.get(length, 0) + k
            total -= length * k
    return found


def pack_lengths(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Patterns ({length: copies}, times) that use up the histogram."""
    counts = {k: v for k, v in histogram.items() if v > 0}
    lengths = sorted(counts, reverse=True)
    out = []
    while lengths:
        found = fullest_bin(lengths, counts, capacity)
        times = min(counts[k] // c for k, c in found.items())
        for k, c in found.items():
            counts[k] -= c * times
        lengths = [k for k in lengths if counts[k]]
        out.append((found, times))
    return out


def slots(patterns: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, arrays over its rank ranges: first rank, copies, first sequence, offset in the sequence."""
    rows: dict[int, list] = {}
    ranks: dict[int, int] = {}
    first = 0
    for found, times in patterns:
        offset = 0
        for length in sorted(found, reverse=True):
            copies = found[length]
            at = ranks.get(length, 0)
            rows.setdefault(length, []).append((at, copies, first, offset))
            ranks[length] = at + copies * times
            offset += length * copies
        first += times
    return {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in rows.items()}


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, n_ids, row_crc32, piece, start, length, ids_crc32) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, begin = enc.encode_all(batch.column("text"))
            n = np.diff(begin)
            flat = np.full(len(ids) + len(n), END_ID, "<u4")
            flat[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n)] = ids
            n, begin = n + 1, begin[:-1] + np.arange(len(n))
            cuts = -(-n // capacity)
            row = np.repeat(np.arange(len(n)), cuts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            start = piece * capacity
            length = np.minimum(capacity, n[row] - start)
            first = begin[row] + start
            crc = [zlib.crc32(flat[i:i + k]) for i, k in zip(first.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return ids.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with the sequence and the place it got there."""
    spark = docs.sparkSession
    prepare(spark)
    cut = materialize(pieces(docs, tokenizer_path, capacity), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = spark.sparkContext.broadcast(slots(pack_lengths(histogram, capacity)))
    order = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "piece"))
    ranked = cut.withColumn("__key", order)
    ranked = ranked.withColumn("__bucket", hash_bucket(F.col("__key"), buckets_for(max(histogram.values(), default=0))))
    ranked = ranked.withColumn("__one", F.lit(1).cast("long"))
    ranked = running_total(ranked, ["length"], "__bucket", ["__key", "doc_id", "piece", "ids_crc32"], "__one", "rank")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_length = table.value
        for pdf in batches:
            length, rank = pdf["length"].to_numpy(np.int64), pdf["rank"].to_numpy(np.int64)
            seq, off = np.empty(len(pdf), np.int64), np.empty(len(pdf), np.int64)
            for k in np.unique(length):
                at = np.flatnonzero(length == k)
                begin, copies, first, offset = by_length[int(k)]
                i = np.searchsorted(begin, rank[at], side="right") - 1
                r = rank[at] - begin[i]
                seq[at] = first[i] + r // copies[i]
                off[at] = offset[i] + k * (r % copies[i])
            yield pdf.drop(columns="rank").assign(sequence_id=seq, offset=off)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return ranked.select(*names, "rank").mapInPandas(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
