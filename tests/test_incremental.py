"""Incremental mode: late batches, months built again, accounts (SC1, J8, G4, PL1, A8, R1-R6)."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from stratalake import TABLES
from stratalake.operators.reconcile import METRICS
from stratalake.operators.scd2 import scd2_chain, scd2_decisive, scd2_rebuild, scd2_splice, scd2_versions
from stratalake.plans import silver as S
from stratalake.plans.incremental import MONTH
from stratalake.plans import stored
from stratalake.plans.pipeline import GOLD_TABLES, Pipeline
from stratalake.plans.queries import StoredChain
from stratalake.sources import fixtures as fx
from stratalake.sources.lake import Lake

from .conftest import rows

SPEC = dict(key="k", updated_at="u", batch="b", attrs=["k", "u", "v"])
SCHEMA = "k long, u timestamp_ntz, v string, b int"


def same(a, b):
    cols = sorted(b.columns)
    return a.select(*cols).exceptAll(b.select(*cols)).count() == 0 and \
        b.select(*cols).exceptAll(a.select(*cols)).count() == 0


# ---- the chain of versions ------------------------------------------------------

def _history(seed, n_keys=40, n_batches=6):
    """Rows of several batches: times go back and forth, some are null, some rows come twice."""
    import datetime as dt
    rng = random.Random(seed)
    out = []
    for k in range(n_keys):
        for b in range(n_batches):
            for _ in range(rng.choice([0, 1, 1, 2])):
                u = None if rng.random() < 0.25 else dt.datetime(2024, 1, 1 + rng.randint(0, 7))
                out.append((k, u, rng.choice("xyz"), b))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_chain_of_batches_in_any_order_equals_rebuild(spark, seed):
    data = _history(seed)
    want = scd2_rebuild(spark.createDataFrame(data, SCHEMA), tie_break=["v"], **SPEC)
    want_rows = sorted(map(repr, want.collect()))
    order = list(range(6))
    random.Random(seed).shuffle(order)
    chain = spark.createDataFrame([], SCHEMA)
    for b in [*order, order[2]]:                      # one batch comes twice
        batch = spark.createDataFrame([r for r in data if r[3] == b], SCHEMA)
        changes = scd2_decisive(chain, batch, tie_break=["v"], **SPEC)
        after = scd2_splice(chain, changes, tie_break=["v"], **SPEC)
        chain = spark.createDataFrame(after.collect(), after.schema)   # stored between batches
    got = scd2_versions(chain, **SPEC)
    assert sorted(map(repr, got.collect())) == want_rows
    assert same(chain, scd2_chain(spark.createDataFrame(data, SCHEMA), tie_break=["v"], **SPEC))


def test_batch_sent_again_is_not_decisive(spark):
    data = _history(5)
    chain = scd2_chain(spark.createDataFrame(data, SCHEMA), tie_break=["v"], **SPEC)
    chain = spark.createDataFrame(chain.collect(), chain.schema)
    for b in range(6):
        batch = spark.createDataFrame([r for r in data if r[3] == b], SCHEMA)
        assert scd2_decisive(chain, batch, tie_break=["v"], **SPEC).count() == 0, b


@pytest.mark.parametrize("seed", [7, 8])
def test_versions_differ_from_since_on(spark, seed):
    """Before ``since`` a key's versions are what they were; a key not named is unchanged."""
    data = _history(seed)
    old_rows = [r for r in data if r[3] != 3]
    new_rows = [r for r in data if r[3] == 3]
    chain = scd2_chain(spark.createDataFrame(old_rows, SCHEMA), tie_break=["v"], **SPEC)
    changes = scd2_decisive(chain, spark.createDataFrame(new_rows, SCHEMA), tie_break=["v"], **SPEC).collect()
    since = {}
    for r in changes:
        since[r["k"]] = None if r["since"] is None or since.get(r["k"], 1) is None else \
            min(r["since"], since.get(r["k"], r["since"]))

    def at(rows_, k, t):
        return [(r["v"], r["valid_from"]) for r in rows_ if r["k"] == k and r["valid_from"] is not None
                and r["valid_from"] <= t and (r["valid_to"] is None or t < r["valid_to"])]

    before = scd2_versions(chain, **SPEC).collect()
    after = scd2_rebuild(spark.createDataFrame(data, SCHEMA), tie_break=["v"], **SPEC).collect()
    import datetime as dt
    for k in range(40):
        for day in range(1, 12):
            t = dt.datetime(2024, 1, day)
            if k not in since or (since[k] is not None and t < since[k]):
                assert at(before, k, t) == at(after, k, t), (k, t)


# ---- a lake fed out of order ------------------------------------------------------

def _files(lake, path):
    from pyspark.sql import SparkSession

    from stratalake.sources.lake import current_folder
    path = current_folder(SparkSession.active(), path)
    return {os.path.relpath(f, path): os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


@pytest.fixture(scope="module")
def backfilled(spark, sf):
    """Batches 1, 3 and 2, each built."""
    return stored.backfilled(spark, sf)


def test_late_batch_gives_all_layers_of_a_rebuild(spark, sf, backfilled):
    rebuilt = StoredChain(spark, sf)
    for t in TABLES:
        assert same(backfilled.silver(t), rebuilt.silver[t]), t
    for t in GOLD_TABLES:
        assert same(backfilled.gold(t), rebuilt.gold[t]), t


def test_accounts_equal_the_full_count(backfilled):
    accounts, full = backfilled.reconcile(full=False).first(), backfilled.reconcile().first()
    assert accounts == full and full["ok"]
    stats = [r for r in backfilled.log if r[0] == "kept/dropped"][-1][2]
    want = S.refine_stats({t: backfilled.bronze(t) for t in TABLES}, {t: backfilled.silver(t) for t in TABLES})
    assert stats == {r["table_name"]: (r["kept"], r["dropped"]) for r in want.collect()}
    assert set(METRICS) <= set(full.asDict())


def test_accounts_read_no_bronze(backfilled):
    plan = backfilled.state.refine_stats({t: backfilled.silver(t) for t in ("customers", "products")})
    assert "/bronze/" not in plan._jdf.queryExecution().executedPlan().toString()


def test_ingest_sent_again_builds_nothing(spark, backfilled):
    before = {p: _files(backfilled.lake, p) for p in (backfilled.lake.gold_path("fact_sales"),
                                                      backfilled.lake.silver_path("order_items"),
                                                      backfilled.state.rows_path("orders"))}
    backfilled._advance_newest(fx.extract_date(3), fx.ingested_at(3))
    assert backfilled.state.marked("silver") == ([], set())
    backfilled.refine()
    backfilled._fact_months()
    assert backfilled.log[-1] == ("refine", [])
    assert {p: _files(backfilled.lake, p) for p in before} == before


def _extract(spark, table, values):
    from stratalake.sources.schemas import RAW
    return spark.createDataFrame(values, RAW[table])


def build(pipe, bronze=None):
    """Silver, customer dimension and fact, without the gates."""
    if bronze is not None:
        pipe.state.advance({t: bronze(t) for t in TABLES})
    pipe.refine()
    pipe._write_dim_customer()
    pipe.state.settle(pipe._fact_months())


def test_small_batch_replaces_its_months_only(spark, sf, tmp_path):
    """A correction of one order and of one customer: other months keep their files, the result is a rebuild's."""
    lake = Lake(str(tmp_path))
    fx.land_extracts(spark, sf, lake)
    for b in (1, 2, 3):
        Pipeline(spark, lake).ingest(fx.extract_date(b), fx.ingested_at(b))
    inc = Pipeline(spark, lake, mode="incremental")
    build(inc, inc.bronze)               # a lake without state starts from all of its bronze
    fact = lake.gold_path("fact_sales")
    line = inc.gold("fact_sales").orderBy("order_item_id").first()
    order = inc.silver("orders").where(F.col("order_id") == line["order_id"]).first()
    customer = inc.silver("customers").orderBy(F.col("customer_id").desc()).first()
    before = _files(lake, fact)
    old_month, new_month = order["order_ts"][:7], "2003-02"
    raw = {"customers": _extract(spark, "customers", [(customer["customer_id"], "Renamed", "smb", None,
                                                       "1998-06-01 00:00:00")]),
           "products": _extract(spark, "products", []),
           # the order moves to a month of its own; its lines are not sent again and follow it
           "orders": _extract(spark, "orders", [(order["order_id"], order["customer_id"], "2003-02-03 00:00:00", "PAID")]),
           "order_items": _extract(spark, "order_items", [])}
    inc.ingest("1999-02-01", "1999-02-01 01:00:00", raw=raw)
    build(inc)
    after = _files(lake, fact)
    touched = {f.split("/")[0].removeprefix(f"{MONTH}=") for f in set(before.items()) ^ set(after.items())
               for f in [f[0]]}
    since = "1998-06"
    assert {old_month, new_month} <= touched
    assert all(m in (old_month, new_month) or m >= since for m in touched)
    assert len(touched) < len({f.split("/")[0] for f in before}) / 3
    reb = Pipeline(spark, lake)
    silver = S.refine_all({t: reb.bronze(t) for t in TABLES})
    from stratalake.plans.gold import build_gold
    gold = build_gold(silver, reb.bronze("customers"))
    for t in TABLES:
        assert same(inc.silver(t), silver[t]), t
    for t in ("dim_customer", "fact_sales"):
        assert same(inc.gold(t), gold[t]), t
    assert inc.reconcile(full=False).first() == inc.reconcile().first()


def test_lake_built_by_rebuild_goes_on_incrementally(spark, sf, tmp_path):
    lake = Lake(str(tmp_path))
    fx.land_extracts(spark, sf, lake)
    first = Pipeline(spark, lake)
    for b in (1, 2):
        first.ingest(fx.extract_date(b), fx.ingested_at(b))
    first.refine()
    inc = Pipeline(spark, lake, mode="incremental")
    inc.ingest(fx.extract_date(3), fx.ingested_at(3))
    build(inc)
    silver = StoredChain(spark, sf).silver
    for t in TABLES:
        assert same(inc.silver(t), silver[t]), t
    assert inc.reconcile(full=False).first()["ok"]


def test_new_customer_and_product_let_old_rows_in(spark, tmp_path):
    """Orders of a customer, and lines of a product, that come only later are trimmed until then."""
    from decimal import Decimal
    one = Decimal("1.00")
    lake = Lake(str(tmp_path))
    inc = Pipeline(spark, lake, mode="incremental")
    inc.ingest("2024-01-01", "2024-01-01 01:00:00", raw={
        "customers": _extract(spark, "customers", [(1, "a", "smb", "x", "2023-01-01 00:00:00")]),
        "products": _extract(spark, "products", [(1, "p", "HW", one)]),
        "orders": _extract(spark, "orders", [(1, 1, "2023-05-01 00:00:00", "PAID"), (2, 2, "2023-06-01 00:00:00", "PAID")]),
        "order_items": _extract(spark, "order_items", [(1, 1, 1, 1, one), (2, 1, 2, 1, one), (3, 2, 1, 2, one),
                                                       (4, 9, 1, 1, one)])})
    build(inc)
    assert rows(inc.gold("fact_sales"), "order_item_id") == [(1,)]
    inc.ingest("2024-01-02", "2024-01-02 01:00:00", raw={
        "customers": _extract(spark, "customers", [(2, "b", "ent", None, "2023-02-01 00:00:00")]),
        "products": _extract(spark, "products", [(2, "q", "SW", one)]),
        "orders": _extract(spark, "orders", [(9, 1, "2023-07-01 00:00:00", "NEW")]),
        "order_items": _extract(spark, "order_items", [])})
    build(inc)
    assert rows(inc.gold("fact_sales"), "order_item_id") == [(1,), (2,), (3,), (4,)]
    assert rows(inc.gold("fact_sales").where("customer_sk IS NULL"), "order_item_id") == []
