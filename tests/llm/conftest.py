import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, hub string, key string, vector string"


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, repeated rows, columns with names the operators use inside."""
    long = " ".join(f"w{i}" for i in range(20_000))
    same = "the quick brown fox jumps over the lazy dog and runs"
    rows = [(1, same, "en", "a"), (1, same, "en", "a"), (2, same + " away", "en", None), (None, None, None, None),
            (3, "", None, "a"), (4, long, "de", "b"), (None, "no id here", "en", "b"), (5, "1234 !!!", "en", "a"),
            (6, None, "fr", "c"), (7, "één\n\nzwei\tdrei", "fr", "c")]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "x", "y", "z") for r in rows], DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)

