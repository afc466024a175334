"""Language identification by interpolated Kneser-Ney character models (operator 5).

Text is lower-cased, everything but letters becomes one space.  Each language
has a Kneser-Ney model of order 4 with one discount per order.  The models are
stored side by side: per order one sorted array of 64-bit n-gram hashes with a
column of log probabilities for each language, so a text is scored against all
languages by one binary search per character.  The language of lowest
cross-entropy per character wins; a text whose cross-entropy exceeds what
texts of that language and length showed in calibration is rejected.

The models are fitted on a bounded sample of labelled rows: at most
``SAMPLE_DOCS`` documents of each language, those of smallest hash, a quarter
of them kept for calibration; rows of equal doc_id, lang and text count as one
document.  All n-grams of the sample are counted, so the sample's texts bound
the broadcast model.  Every document is scored over its whole text.

Defined results: a null text or one without letters is ``und`` with score 0
and rejected; equal cross-entropies go to the smaller language name; rows are
scored one by one, so repeats agree; without labelled rows all are ``und``; a
language without a calibration text rejects nothing;
an empty table gives no rows; extra columns of any name pass through
``classify``, which replaces those named like its own.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_column, materialize, prepare

ORDER = 4
SAMPLE_DOCS = 2000
#: Uniform floor: every code point may follow, known or not.
CHARACTERS = 1 << 17
#: A text is rejected above this quantile of the calibration texts of its language and length, times the margin: the
#: quantile leaves out noisy texts, the margin keeps the clean ones above it.  Lengths with fewer than ``LEAST_TEXTS``
#: texts take those of the nearest lengths too.
QUANTILE, MARGIN = 0.95, 1.5
LEAST_TEXTS = 50
#: Two standard errors of the mean of n characters are about this over the root of n, in bits: few texts of a length
#: do not show how much short ones vary.
SPREAD = 6.0
LONGEST = 14
UNKNOWN = "und"

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def code_points(text: str | None) -> np.ndarray:
    """The normalised text as code points, opened by a space; empty without letters."""
    raw = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    known = letters()[raw]
    if not known.any():
        return np.empty(0, np.uint64)
    raw = np.concatenate([[np.uint32(32)], np.where(known, raw, np.uint32(32))])
    space = raw == 32
    return raw[~(space & np.concatenate([[False], space[:-1]]))].astype(np.uint64)


def hashes(points: np.ndarray, order: int) -> np.ndarray:
    """Hash of the n-gram that ends at each position; n-grams beyond the start are cut short."""
    h = np.full(len(points), order, np.uint64)
    for back in range(order - 1, -1, -1):
        shifted = np.concatenate([np.zeros(min(back, len(points)), np.uint64), points[:len(points) - back]])
        h = (h ^ shifted) * _PRIME
        h ^= h >> np.uint64(29)
    return h


def hash_of(gram: str) -> int:
    return int(hashes(np.array([ord(c) for c in gram], np.uint64), len(gram))[-1])


@dataclass
class Model:
    languages: list[str]
    keys: list[np.ndarray] = field(default_factory=list)       # per order 1..ORDER, sorted
    logp: list[np.ndarray] = field(default_factory=list)       # [keys, languages]
    contexts: list[np.ndarray] = field(default_factory=list)   # per order: sorted hashes of contexts
    backoff: list[np.ndarray] = field(default_factory=list)
    limits: dict[tuple[str, int], float] = field(default_factory=dict)

    def score(self, points: np.ndarray) -> np.ndarray:
        """Log probability of each position's character, [positions, languages]."""
        return self._at(ORDER, [hashes(points, k) for k in range(1, ORDER + 1)],
                        [hashes(points, k)[:-1] for k in range(1, ORDER)], np.arange(len(points)))

    def _at(self, order: int, grams: list[np.ndarray], before: list[np.ndarray], where: np.ndarray) -> np.ndarray:
        """``before[k-1][i-1]`` is the hash of the k characters before position i."""
        out = np.zeros((len(where), len(self.languages)), np.float32)
        if order == 0:
            return out - np.float32(math.log(CHARACTERS))
        wanted = grams[order - 1][where]
        keys = self.keys[order - 1]
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = keys[at] == wanted
        out[hit] = self.logp[order - 1][at[hit]]
        miss = np.flatnonzero(~hit)
        if len(miss):
            lower = self._at(order - 1, grams, before, where[miss])
            if order == 1:
                lower = lower + self.backoff[0][0]
            else:
                context = before[order - 2][np.maximum(where[miss] - 1, 0)]
                known = self.contexts[order - 1]
                at = np.minimum(np.searchsorted(known, context), len(known) - 1)
                found = known[at] == context
                lower[found] += self.backoff[order - 1][at[found]]
            out[miss] = lower
        return out

    def classify(self, text: str | None) -> tuple[str, float, float, int, bool]:
        """(language, score, cross-entropy per character in bits, length class, rejected)."""
        points = code_points(text)
        if len(points) < 2 or not self.languages:
            return UNKNOWN, 0.0, 0.0, 0, True
        total = np.zeros(len(self.languages))
        for a in range(1, len(points), 1 << 20):  # bounded memory on very long texts
            lo = max(0, a - ORDER)
            part = self.score(points[lo:a + (1 << 20)])
            total += part[a - lo:].sum(axis=0, dtype=np.float64)
        n = len(points) - 1
        mean = total / n
        best = int(np.argmax(mean))
        weight = np.exp((mean - mean[best]) * min(n, 64))
        bits = -float(mean[best]) / math.log(2)
        limit = self.limits.get((self.languages[best], length_class(n)))
        return (self.languages[best], float(1 / weight.sum()), bits, length_class(n),
                limit is not None and bits > limit)


def length_class(n: int) -> int:
    return min(LONGEST, n.bit_length())


def limits(seen: list[tuple[int, float]]) -> dict[int, float]:
    """(length class, bits) of a language's calibration texts -> limit of every length class, calibrated or not."""
    found: dict[int, float] = {}
    if not seen:
        return found
    classes, bits = np.array([c for c, _ in seen]), np.array([b for _, b in seen])
    for c in range(LONGEST, -1, -1):
        far = np.abs(classes - c)
        near = far <= np.sort(far)[min(len(far), LEAST_TEXTS) - 1]
        # shorter texts vary more, never less
        found[c] = max(found.get(c + 1, 0.0), float(np.quantile(bits[near], QUANTILE)) * MARGIN)
    return {c: limit + SPREAD / 2 ** (max(c - 1, 0) / 2) for c, limit in found.items()}


def kneser_ney(counts: dict[str, int]) -> tuple[list[dict[str, float]], list[dict[str, float]]]:
    """Counts of n-grams of full order -> per order: log p of n-grams, log back-off weight of contexts."""
    tables: list[dict[str, float]] = [dict(counts)]
    for _ in range(ORDER - 1):  # continuation counts: how many characters come before
        tables.insert(0, Counter(g[1:] for g in tables[0]))
    probs: list[dict[str, float]] = []
    backoffs: list[dict[str, float]] = []
    for k, table in enumerate(tables):
        ones, twos = (sum(1 for v in table.values() if v == x) for x in (1, 2))
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        total, kinds = defaultdict(float), Counter()
        for g, c in table.items():
            total[g[:-1]] += c
            kinds[g[:-1]] += 1
        gamma = {h: discount * kinds[h] / total[h] for h in total}
        p = {}
        for g, c in table.items():
            lower = 1 / CHARACTERS if k == 0 else probs[k - 1].get(g[1:])
            p[g] = max(c - discount, 0.0) / total[g[:-1]] + gamma[g[:-1]] * lower
        probs.append(p)
        backoffs.append(gamma)
    return ([{g: math.log(v) for g, v in p.items()} for p in probs],
            [{h: math.log(v) for h, v in b.items()} for b in backoffs])


def build(counts: dict[str, dict[str, int]]) -> Model:
    """Join the languages' models: {language: {n-gram: count}}."""
    model = Model(sorted(counts))
    built = [kneser_ney(counts[x]) for x in model.languages]

    def log_p(lang: int, gram: str) -> float:
        if not gram:
            return -math.log(CHARACTERS)
        probs, backoffs = built[lang]
        if gram in probs[len(gram) - 1]:
            return probs[len(gram) - 1][gram]
        return backoffs[len(gram) - 1].get(gram[:-1], 0.0) + log_p(lang, gram[1:])

    for k in range(ORDER):
        grams = sorted({g for p, _ in built for g in p[k]}, key=hash_of)
        model.keys.append(np.array([hash_of(g) for g in grams], np.uint64))
        model.logp.append(np.array([[log_p(i, g) for i in range(len(built))] for g in grams], np.float32))
        held = sorted({h for _, b in built for h in b[k]}, key=lambda h: hash_of(h) if h else 0)
        model.contexts.append(np.array([hash_of(h) if h else 0 for h in held], np.uint64))
        model.backoff.append(np.array([[b[k].get(h, 0.0) for _, b in built] for h in held], np.float32))
    return model


def count_ngrams(docs: DataFrame) -> DataFrame:
    """(lang, text) -> (lang, gram, n) over whole texts, summed per batch before the shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(pdf["lang"], pdf["text"]):
                s = " " * (ORDER - 2) + "".join(map(chr, code_points(text)))
                seen[lang].update(s[i:i + ORDER] for i in range(len(s) - ORDER + 1))
            rows = [(x, g, n) for x, c in seen.items() for g, n in c.items()]
            yield pd.DataFrame(rows, columns=["lang", "gram", "n"])

    return (docs.select("lang", "text").mapInPandas(run, "lang string, gram string, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def fit(docs: DataFrame, learn: Column, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on the rows of (doc_id, text, lang) where ``learn`` holds and lang is known."""
    prepare(docs.sparkSession)
    key = F.md5(F.concat(F.lit("langid|"), F.col("doc_id").cast("string")))
    # equal rows share a place
    place = F.dense_rank().over(Window.partitionBy("lang").orderBy("__key", "doc_id", "__text"))
    labelled = (docs.where(learn & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
                .select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
                .withColumn("__text", F.xxhash64("text")))
    chosen = (labelled.select("doc_id", "lang", "__text").distinct().withColumn("__key", key)
              .withColumn("__place", place).where(F.col("__place") <= sample_docs)
              .select("doc_id", "lang", "__text", (F.col("__place") % 4 == 0).alias("calibrate")))
    # written first: the planner then knows how few ids there are and need not shuffle all texts
    chosen = materialize(chosen, "langid-ids")
    same = ["doc_id", "lang", "__text"]
    sample = materialize(labelled.join(chosen, same).dropDuplicates(same), "langid-sample")
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    for r in count_ngrams(sample.where("not calibrate")).collect():
        counts[r["lang"]][r["gram"]] = r["n"]
    model = build(counts)
    if model.languages:
        seen: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for r in (classify(sample.where("calibrate"), model).where("lang = lang_pred")
                  .select("lang", "length_class", "bits").collect()):
            seen[r["lang"]].append((r["length_class"], r["bits"]))
        for lang, texts in seen.items():
            model.limits |= {(lang, c): limit for c, limit in limits(texts).items()}
    return model


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without text, with lang_pred, score, bits, length_class and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = {"lang_pred": "string", "score": "double", "bits": "double", "length_class": "int", "rejected": "boolean"}

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            yield pd.DataFrame([m.classify(t) for t in texts], columns=list(added))

    return map_column(docs, "text", added, run)


def keep_accepted(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the documents that identification rejects."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def rejected(text: pd.Series) -> pd.Series:
        return pd.Series([shared.value.classify(t)[4] for t in text], dtype=bool)

    return docs.where(~rejected("text"))
