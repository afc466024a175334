"""A training corpus from raw documents: five stages, each one operator of stratalake.llm.

Every stage takes what its predecessor kept, written as Parquet and read back,
and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratalake.llm import langid, mixing, ngram_join, packing, toxicity
from stratalake.llm.common import materialize, prepare, table
from stratalake.llm.queries import fold, word_tokenizer

#: No stage from language models and compression on can be written in SQL.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a letter, or unlike every learned language, go."""
    prepare(spark)
    return langid.keep_accepted(docs, langid.fit(docs, fold(4) != 2))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that score 0.7 or more go."""
    prepare(spark)
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    return toxicity.keep_ordinary(docs, toxicity.fit(docs, labels, fold(3) != 1))


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each class of near copies stays."""
    prepare(spark)
    return ngram_join.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: sources at their target weights, a row for each epoch of a document."""
    prepare(spark)
    return mixing.take(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing into sequences of 2048 tokens."""
    prepare(spark)
    return packing.pack(docs, word_tokenizer())


STAGES = [("language ID", known_language), ("toxicity", not_toxic), ("n-gram Jaccard join", no_near_copies),
          ("mixing sources", mixed), ("best-fit packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
