"""Toxicity by compression distance (operator 4), with a word list in place of a toxic dictionary.

Two zstandard dictionaries are made from labelled text: both open with one
dictionary trained on ordinary text and close with what is characteristic of
their class, words of toxic documents that ordinary ones lack, or ordinary
documents' commonest words.  No dictionary is trained on toxic text, and toxicity
in phrases of ordinary words or in words rarer than the floors below is not seen
(README has the figures of separately trained dictionaries).  A text is cut into windows (its words, long ones
in pieces); a window's distance is the share of its compressed length that the
toxic dictionary saves against the ordinary one, and a document is as toxic as
its window of largest distance.  A threshold calibrated on the labelled sample
turns that into a score of 0.7 at the threshold.

Characters are coded as three bytes each before training and compression: a
window is short, and the wider code makes a length count a match of a few
characters and not the fixed costs of a block.

The model is fitted on at most ``LABELLED_ROWS`` labelled rows, those of
smallest hash, whole texts; copies (equal whole texts) count once, so that
words of a copied document do not pass for its class.  The two
dictionaries hold at most ``LEXICON`` words each.  Every document is scored
over its whole text.

Defined results: a null or empty text has distance 0 and the lowest score;
rows are scored one by one, so repeats agree; without toxic labels every
score is 0; labels other than 0 and 1 and repeated or contradicting labels of
a document are ignored; an empty table gives no rows; extra columns pass
through ``score``.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, map_column, materialize, prepare

LABELLED_ROWS = 20_000
BASE_DOCS = 600            # ordinary documents that the shared part is trained on
LEXICON = 2000
BASE_BYTES = 3072
PIECE = 40                 # longest window, in characters
MIN_DOCS, MIN_SHARE, LIFT = 4, 0.012, 20.0
THRESHOLD_SCORE = 0.7
SLOPE = 25.0
#: Windows whose distance a worker keeps; the table starts anew beyond it (memory, not results).
CACHE_WINDOWS = 800_000

_EDGE = ".,;:!?*#$%&|\"'()"
_WORD = re.compile(WORD)
_CODE: dict[str, bytes] = {}
_STATE: dict = {}


def windows(text: str | None) -> set[str]:
    """The distinct windows of a whole text."""
    out = set()
    for w in set(_WORD.findall((text or "").lower())):
        w = w.strip(_EDGE)
        if len(w) <= PIECE:
            out.add(w)
        else:
            out.update(w[i:i + PIECE] for i in range(0, len(w), PIECE))
    out.discard("")
    return out


def encode(text: str) -> bytes:
    for c in set(text):
        if c not in _CODE:
            _CODE[c] = hashlib.blake2b(c.encode("utf-8", "replace"), digest_size=3).digest()
    return b"".join(map(_CODE.__getitem__, text))


@dataclass
class Model:
    toxic: bytes = b""
    ordinary: bytes = b""
    threshold: float = 1.0
    lexicon: list[str] = field(default_factory=list)

    def compressors(self):
        import zstandard as z

        params = z.ZstdCompressionParameters(
            strategy=z.STRATEGY_LAZY2, min_match=6, window_log=16, hash_log=13, chain_log=13, search_log=5,
            target_length=64, write_content_size=False, write_checksum=False, write_dict_id=False,
            format=z.FORMAT_ZSTD1_MAGICLESS)
        out = []
        for content in (self.ordinary, self.toxic):
            d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            out.append(z.ZstdCompressor(dict_data=d, compression_params=params))
        return out


class Scorer:
    """Distances of texts under one model, with the windows met so far."""

    def __init__(self, model: Model):
        self.model, self.known = model, {"": 0.0}
        if model.toxic:
            self.ordinary, self.toxic = model.compressors()

    def _window(self, w: str) -> float:
        raw = encode(f" {w} ")
        a = len(self.ordinary.compress(raw))
        d = self.known[w] = (a - len(self.toxic.compress(raw))) / a
        return d

    def distance(self, text: str | None) -> float:
        if not self.model.toxic:
            return 0.0
        if len(self.known) > CACHE_WINDOWS:
            self.known = {"": 0.0}
        known = self.known
        return max([0.0, *(known[w] if w in known else self._window(w) for w in windows(text))])


def scorer(model: Model) -> Scorer:
    key = hashlib.blake2b(model.toxic + model.ordinary, digest_size=8).digest()
    if key not in _STATE:
        _STATE.clear()
        _STATE[key] = Scorer(model)
    return _STATE[key]


def distances(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without text, with ``distance``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        s = scorer(shared.value)
        for texts in batches:
            yield pd.DataFrame({"distance": [s.distance(t) for t in texts]}, dtype="float64")

    return map_column(docs, "text", {"distance": "double"}, run)


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = LABELLED_ROWS) -> DataFrame:
    """(doc_id, text, toxic) of at most ``rows`` labelled documents where ``learn`` holds on doc_id."""
    clean = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id")
             .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("__max")).where("toxic = __max").drop("__max"))
    order = F.md5(F.concat(F.lit("toxicity|"), F.col("doc_id").cast("string")))
    chosen = materialize(clean.where(learn).orderBy(order).limit(rows), "toxic-ids")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # of an id's texts the one of smallest digest
    first = F.min(F.struct(F.xxhash64("text"), F.col("text").alias("text"))).alias("__first")
    return (texts.join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(first)
            .select("doc_id", F.col("__first.text").alias("text"), "toxic"))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = LABELLED_ROWS) -> Model:
    """Train dictionaries and threshold on labelled rows where ``learn`` (on doc_id) holds."""
    import zstandard as z

    prepare(docs.sparkSession)
    sample = materialize(labelled_sample(docs, labels, learn, rows), "toxic-sample")

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(hashlib.blake2b(t.encode("utf-8", "replace"), digest_size=16).hexdigest(), y, i, list(windows(t)))
                   for i, t, y in zip(pdf["doc_id"], pdf["text"], pdf["toxic"])]
            yield pd.DataFrame(out, columns=["digest", "toxic", "doc_id", "words"])

    bags = sample.mapInPandas(words, "digest string, toxic int, doc_id long, words array<string>")
    first = F.row_number().over(Window.partitionBy("digest", "toxic").orderBy("doc_id"))
    bags = materialize(bags.withColumn("__first", first).where("__first = 1").drop("__first"), "toxic-words")
    sizes = bags.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    n_toxic = sizes[0] or 0
    n_ordinary = sizes[1] - n_toxic
    if not n_toxic or not n_ordinary:
        return Model()
    counts = (bags.select(F.explode("words").alias("word"), "toxic").groupBy("word")
              .agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("o")))
    counts = materialize(counts, "toxic-counts")
    least = max(MIN_DOCS, int(MIN_SHARE * n_toxic))
    lexicon = [r["word"] for r in counts
               .where((F.col("t") >= least) & (F.char_length("word") > 2)
                      & (F.col("t") / n_toxic > LIFT * (F.col("o") + 0.5) / n_ordinary))
               .orderBy(F.desc("t"), "word").limit(LEXICON).collect()]
    if not lexicon:
        return Model()
    common = [r["word"] for r in counts.orderBy(F.desc("o"), "word").limit(LEXICON).collect()]
    # most frequent words last: a smaller offset is a shorter match
    toxic_part = " " + " ".join(reversed(lexicon)) + " "
    ordinary_part = (" " + " ".join(common))[:len(toxic_part) - 1] + " "
    base = [" ".join(_WORD.findall(r["text"].lower())) for r in
            sample.where("toxic = 0").orderBy("doc_id").limit(BASE_DOCS).select("text").collect()]
    pieces = [encode(t[i:i + 200]) for t in base for i in range(0, len(t), 200)]
    try:
        shared = z.train_dictionary(BASE_BYTES, pieces).as_bytes()
    except z.ZstdError:  # too little text to train on: the text itself serves
        shared = b"".join(pieces)[-BASE_BYTES:]
    model = Model(shared + encode(toxic_part), shared + encode(ordinary_part), 1.0, lexicon)
    seen = distances(sample, model).select("distance", "toxic").toPandas()
    x, y = seen["distance"].to_numpy(), seen["toxic"].to_numpy()
    grid = np.arange(0.2, 0.7, 0.01)
    gain = np.array([(x[y == 1] >= g).mean() - 5 * (x[y == 0] >= g).mean() for g in grid])
    model.threshold = float(np.median(grid[gain >= gain.max() - 0.005]))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without text, with distance, score and predicted."""
    scored = distances(docs, model).withColumn("score", _score(F.col("distance"), model))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD_SCORE).cast("int"))


def _score(distance: Column, model: Model) -> Column:
    """Logistic in the distance, THRESHOLD_SCORE at the threshold."""
    if not model.toxic:
        return F.lit(0.0)
    odds = math.log(THRESHOLD_SCORE / (1 - THRESHOLD_SCORE)) + 1e-9
    return 1 / (1 + F.exp(-(SLOPE * (distance - F.lit(model.threshold)) + odds)))


def keep_ordinary(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the documents predicted toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def distance(text: pd.Series) -> pd.Series:
        s = scorer(shared.value)
        return pd.Series([s.distance(t) for t in text], dtype="float64")

    return docs.where(_score(distance("text"), model) < THRESHOLD_SCORE)
