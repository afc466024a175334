"""Every registered query equals its DuckDB oracle (row multiset, by column name)."""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from stratalake.plans.queries import QUERIES

SOURCES = ("region nation customer supplier part orders lineitem events documents "
           "embeddings pages benchmark labels conversations").split()


def _canon(v):
    if v is None or v is getattr(__import__("pandas"), "NaT"):
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v == int(v) else round(v, 6)
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if isinstance(v, datetime.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, datetime.date):
        return datetime.datetime(v.year, v.month, v.day).isoformat(sep=" ")
    try:
        import pandas as pd
        if v is pd.NA:
            return None
    except Exception:
        pass
    if hasattr(v, "item"):
        return _canon(v.item())
    return v


def _norm(pdf):
    cols = sorted(pdf.columns)
    pdf = pdf[cols].astype(object)
    return cols, sorted((tuple(repr(_canon(v)) for v in r) for r in pdf.itertuples(index=False)))


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in SOURCES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, sf, con, name):
    got = _norm(E.queries()[name](spark, sf).toPandas())
    want = _norm(con.execute(E.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_every_query_has_an_oracle():
    # operators of the optional package that SQL cannot express have brute-force tests instead
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["status", "lines", "units", "revenue", "unresolved"]
