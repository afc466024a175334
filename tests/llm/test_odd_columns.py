"""Columns of any name pass through; samples are bounded in rows and the same on every run."""

import math

import pytest
from pyspark.sql import functions as F

from stratalake.llm import langid, mixing, ngram_join, toxicity
from stratalake.llm.langid import CHARACTERS, ORDER

SF = "/root/testdata/sf0.001"
EXTRA = ["a.b", "c d", "__key", "__first", "__same", "__nth", "__piece", "__size", "__taken", "__d", "value", "c0"]


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    return base.select(*base.columns, *[F.col("doc_id").alias(c) for c in EXTRA])


def _same(out, docs):
    """The extra columns still hold the row's own doc_id."""
    assert [c for c in out.columns if c in EXTRA] == EXTRA
    wrong = out.where(" OR ".join(f"NOT (`{c}` <=> doc_id)" for c in EXTRA))
    assert wrong.count() == 0
    return out


def test_filters_keep_odd_columns(spark, docs):
    base = docs.drop(*EXTRA)
    model = langid.fit(docs, F.lit(True))
    kept = _same(langid.keep_accepted(docs, model), docs)
    assert kept.count() == langid.keep_accepted(base, model).count()
    assert _same(langid.classify(docs, model), docs).count() == docs.count()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    tox = toxicity.fit(docs, labels, F.lit(True))
    assert _same(toxicity.keep_ordinary(docs, tox), docs).count() == toxicity.keep_ordinary(base, tox).count()
    assert _same(toxicity.score(docs, tox), docs).count() == docs.count()
    assert _same(ngram_join.keep_one(docs), docs).count() == ngram_join.keep_one(base).count()
    assert _same(mixing.take(docs), docs).count() == mixing.take(base).count()


def test_language_sample_counts_documents_and_not_copies(spark, monkeypatch):
    rows = [(1, "same words again and again", "en")] * 500 + [(i, f"words of text {i}", "en") for i in range(2, 40)]
    rows += [(1, "another text of one id", "en"), (50, None, "en"), (None, "no id", "en"), (60, "no language", None)]
    seen = {}
    real = langid.materialize

    def watched(df, name):
        seen[name] = real(df, name)
        return seen[name]

    monkeypatch.setattr(langid, "materialize", watched)
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langid.fit(table, F.lit(True), sample_docs=4)
    assert seen["langid-sample"].count() == 4
    langid.fit(table, F.lit(True), sample_docs=10_000)
    assert seen["langid-sample"].count() == 1 + 38 + 1 + 1
    langid.fit(table.limit(0), F.lit(True))
    assert seen["langid-sample"].count() == 0


def test_toxic_sample_takes_the_same_text_of_an_id(spark):
    rows = [(1, f"text {i}") for i in range(50)] + [(2, "only"), (2, "only")]
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    got = [sorted(map(tuple, toxicity.labelled_sample(spark.createDataFrame(rows[::step], "doc_id long, text string")
                                                      .repartition(n), labels, F.lit(True)).collect()))
           for step, n in ((1, 1), (-1, 7), (1, 3))]
    assert got[0] == got[1] == got[2] and [r[0] for r in got[0]] == [1, 2]


def _plain_kneser_ney(counts):
    """Interpolated Kneser-Ney by its recursion, from full-order counts."""
    tables = [counts]
    for _ in range(ORDER - 1):
        lower = {}
        for g in tables[0]:
            lower[g[1:]] = lower.get(g[1:], 0) + 1
        tables.insert(0, lower)

    def p(gram):
        if not gram:
            return 1 / CHARACTERS
        table = tables[len(gram) - 1]
        ones = sum(v == 1 for v in table.values())
        twos = sum(v == 2 for v in table.values())
        d = ones / (ones + 2 * twos) if ones and twos else 0.5
        after = {g: c for g, c in table.items() if g[:-1] == gram[:-1]}
        if not after:
            return p(gram[1:])
        total = sum(after.values())
        return max(after.get(gram, 0) - d, 0) / total + d * len(after) / total * p(gram[1:])
    return p


def test_arrays_equal_plain_kneser_ney():
    texts = {"aa": "the cat sat on the mat and the rat ran to the hat " * 2, "bb": "le chat est sur le tapis et le rat court "}
    counts = {}
    for lang, text in texts.items():
        s = " " * (ORDER - 2) + text
        counts[lang] = {}
        for i in range(len(s) - ORDER + 1):
            counts[lang][s[i:i + ORDER]] = counts[lang].get(s[i:i + ORDER], 0) + 1
    probs, backoffs = langid.kneser_ney(counts["aa"])
    plain = _plain_kneser_ney(counts["aa"])
    grams = set(counts["aa"]) | set(counts["bb"]) | {"qqqq", "the ", "zthe"}
    for g in grams:
        def log_p(x):
            if not x:
                return -math.log(CHARACTERS)
            if x in probs[len(x) - 1]:
                return probs[len(x) - 1][x]
            return backoffs[len(x) - 1].get(x[:-1], 0.0) + log_p(x[1:])
        assert log_p(g) == pytest.approx(math.log(plain(g)), abs=1e-9)
