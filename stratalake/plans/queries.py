"""Registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

Every query starts from the supplied tables, derives the raw extracts
(``sources.fixtures``) and runs the layers as one Catalyst plan.  Nothing is
sampled or capped: each query covers the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import TABLES
from ..operators import contracts as C
from ..operators.joins import asof_within, sweep_join
from ..operators.windows import next_in_key
from ..operators.reconcile import (CHECKS, METRICS, differing_rows, recon_checks, recon_metrics,
                                   validity_audit)
from ..functions.expressions import line_amount
from ..session import settings
from ..sources import fixtures as fx
from ..sources.lake import scratch_lake, table_history, table_version
from ..sources.schemas import EXTRACT_DATE, GOLD, INGESTED_AT, SILVER
from ..sources.tables import read_source
from . import gold as G
from . import silver as S
from . import stored
from .faults import faulty_gold, faulty_silver, misdated_fact, swapped_amounts


def _union(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


class Chain:
    """The layers for one fixture variant, built lazily and memoised per object."""

    def __init__(self, spark: SparkSession, sf_dir: str, variant: str = "clean",
                 upto: int | None = None):
        self.spark, self.sf_dir, self.variant, self.upto = spark, sf_dir, variant, upto
        self._cache: dict = {}

    def _m(self, name, fn):
        if name not in self._cache:
            self._cache[name] = fn()
        return self._cache[name]

    @property
    def bronze(self) -> dict[str, DataFrame]:
        return self._m("bronze", lambda: {
            t: fx.bronze_history(self.spark, self.sf_dir, t, self.upto, self.variant)
            for t in TABLES})

    @property
    def silver(self) -> dict[str, DataFrame]:
        return self._m("silver", lambda: S.refine_all(self.bronze))

    @property
    def staged(self) -> dict[str, DataFrame]:
        return self._m("staged", lambda: G.stage_all(self.silver))

    @property
    def snapshot(self) -> DataFrame:
        return self._m("snapshot", lambda: G.customer_snapshot_rebuild(self.bronze["customers"]))

    @property
    def dim_customer(self) -> DataFrame:
        return self._m("dim_customer", lambda: G.dim_customer(self.snapshot))

    @property
    def fact_lines(self) -> DataFrame:
        """Silver order lines for the fact, without the check against silver
        orders: the fact's inner join with the orders on ``order_id`` keeps
        the same lines, so the line table is shuffled once, not twice."""
        return self._m("fact_lines", lambda: G.stage(S.finish_order_items(
            S.newest_rows(self.bronze["order_items"], "order_items"), None,
            self.silver["products"]), "order_items"))

    def fact_sales(self, dim: DataFrame | None = None, open_upper: bool = True) -> DataFrame:
        return G.fact_sales(self.fact_lines, self.staged["orders"],
                            dim if dim is not None else self.dim_customer, open_upper)

    @property
    def gold(self) -> dict[str, DataFrame]:
        return self._m("gold", lambda: {
            "customer_snapshot": self.snapshot,
            "dim_customer": self.dim_customer,
            "dim_product": G.dim_product(self.staged["products"]),
            "dim_date": G.dim_date(self.staged["orders"]),
            "fact_sales": self.fact_sales(),
        })

    def recon(self, fact: DataFrame | None = None, dim: DataFrame | None = None) -> DataFrame:
        return recon_metrics(fact if fact is not None else self.gold["fact_sales"],
                             self.silver["order_items"],
                             dim if dim is not None else self.dim_customer,
                             self.silver["customers"])


class StoredChain(Chain):
    """The layers of a fixture variant, each written once below the session's
    shared folder and read back.

    For reports that read a layer many times: as one lazy plan, every use would
    scan the sources and build the layer again."""

    def __init__(self, spark: SparkSession, sf_dir: str, variant: str = "clean", newest: dict[str, DataFrame] | None = None):
        """``newest``: newest rows of some tables that the caller has already."""
        super().__init__(spark, sf_dir, variant)
        self.lake = scratch_lake(spark)
        self._newest = newest or {}

    def _stored(self, path: str, df: DataFrame, schema) -> DataFrame:
        self.lake.overwrite(df, path)
        return self.lake.read(self.spark, path, schema)

    def _silver_table(self, t: str, df: DataFrame) -> DataFrame:
        return self._stored(self.lake.silver_path(t), df, SILVER[t])

    @property
    def silver(self) -> dict[str, DataFrame]:
        return self._m("silver", self._write_silver)

    def _write_dimensions(self) -> dict[str, DataFrame]:
        return {"customers": self._silver_table("customers", S.refine_customers(self.bronze["customers"])),
                "products": self._silver_table("products", S.refine_products(self.bronze["products"]))}

    def _write_silver(self) -> dict[str, DataFrame]:
        newest = {t: self._newest[t] if t in self._newest else S.newest_rows(self.bronze[t], t)
                  for t in ("orders", "order_items")}
        out = self._write_dimensions()
        out["orders"] = self._silver_table("orders", S.finish_orders(newest["orders"], out["customers"]))
        out["order_items"] = self._silver_table("order_items", S.finish_order_items(
            newest["order_items"], out["orders"], out["products"]))
        return out

    @property
    def dim_customer(self) -> DataFrame:
        return self._m("dim_customer", lambda: self._stored(
            self.lake.gold_path("dim_customer"), G.dim_customer(super(StoredChain, self).snapshot), GOLD["dim_customer"]))

    @property
    def snapshot(self) -> DataFrame:
        return self.dim_customer.select("customer_id", "name", "segment", "city",
                                        F.col("valid_from").alias("updated_at"),
                                        F.col("customer_sk").alias("scd_id"), "valid_from", "valid_to")

    @property
    def fact_lines(self) -> DataFrame:
        return self.staged["order_items"]

    @property
    def gold(self) -> dict[str, DataFrame]:
        return self._m("gold", lambda: {
            "customer_snapshot": self.snapshot,
            "dim_customer": self.dim_customer,
            "dim_product": G.dim_product(self.staged["products"]),
            "dim_date": G.dim_date(self.staged["orders"]),
            "fact_sales": self._stored(self.lake.gold_path("fact_sales"), self.fact_sales(), GOLD["fact_sales"]),
        })


class EarlyChain(StoredChain):
    """The variant with early orders beside a clean chain: customers and products are those of the clean
    one, and the fact, which only the reconciliation reads, is not stored."""

    def __init__(self, clean: StoredChain, newest: dict[str, DataFrame]):
        super().__init__(clean.spark, clean.sf_dir, "early_new_orders", newest)
        self.clean = clean

    def _write_dimensions(self) -> dict[str, DataFrame]:
        return {t: self.clean.silver[t] for t in ("customers", "products")}

    @property
    def dim_customer(self) -> DataFrame:
        return self.clean.dim_customer

    def recon(self, fact: DataFrame | None = None, dim: DataFrame | None = None) -> DataFrame:
        return super().recon(fact if fact is not None else self.fact_sales(), dim)


def stored_variants(spark: SparkSession, sf_dir: str) -> tuple[StoredChain, EarlyChain]:
    """The clean layers and those with early orders; the newest rows of both are found and stored together."""
    lake = scratch_lake(spark)
    both = {}
    for t in ("orders", "order_items"):
        rows = S.newest_rows_where(fx.bronze_of_both(spark, sf_dir, t), t, fx.IN_CLEAN)
        lake.overwrite(rows, lake.state_path(f"newest_{t}"))
        both[t] = lake.read(spark, lake.state_path(f"newest_{t}"), rows.schema)
    clean = StoredChain(spark, sf_dir, newest={t: df.where("__some") for t, df in both.items()})
    return clean, EarlyChain(clean, {t: df.where("__all") for t, df in both.items()})


# ---- bronze -------------------------------------------------------------------

def bronze_lineage_counts(spark, sf_dir):
    """S1, P1, BR1, U1, A1: rows per table and ingest batch."""
    ch = Chain(spark, sf_dir)
    return _union([
        ch.bronze[t].groupBy(EXTRACT_DATE, INGESTED_AT).agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(t).alias("table_name"), F.col(EXTRACT_DATE).alias("extract_date"),
                F.col(INGESTED_AT).alias("ingested_at"), "rows")
        for t in TABLES])


def bronze_history(spark, sf_dir):
    """One row per commit of every bronze table."""
    ch = Chain(spark, sf_dir)
    return _union([table_history(ch.bronze[t]).select(F.lit(t).alias("table_name"), "*")
                   for t in TABLES])


def bronze_version(spark, sf_dir):
    """Latest 0-based version and row count per bronze table."""
    ch = Chain(spark, sf_dir)
    return _union([table_version(ch.bronze[t]).select(F.lit(t).alias("table_name"), "*")
                   for t in TABLES])


# ---- silver -------------------------------------------------------------------

def _silver_table(table):
    def q(spark, sf_dir):
        return Chain(spark, sf_dir).silver[table]
    q.__doc__ = f"SV: silver {table}"
    return q


def silver_as_of(spark, sf_dir):
    """SV3 on bronze as it stood after batch 2 (rebuild-as-of)."""
    ch = Chain(spark, sf_dir)
    cut = fx.ingested_at(2)
    b = {t: S.as_of(ch.bronze[t], cut) for t in ("customers", "orders")}
    return S.refine_orders(b["orders"], S.refine_customers(b["customers"]))


def refine_stats(spark, sf_dir):
    """SV5/A8: kept and dropped rows per table."""
    ch = StoredChain(spark, sf_dir)
    return S.refine_stats(ch.bronze, ch.silver)


def staged_orders(spark, sf_dir):
    return Chain(spark, sf_dir).staged["orders"]


def staged_items(spark, sf_dir):
    return Chain(spark, sf_dir).staged["order_items"]


# ---- SCD2 ---------------------------------------------------------------------

def scd2_rebuild(spark, sf_dir):
    """SC2: the snapshot from the whole bronze history."""
    return Chain(spark, sf_dir).snapshot


def scd2_incremental(spark, sf_dir):
    """SC1 replayed after each batch, on the silver customers of that moment."""
    ch = Chain(spark, sf_dir)
    hist = None
    for b in fx.batch_numbers():
        current = S.refine_customers(S.as_of(ch.bronze["customers"], fx.ingested_at(b)))
        hist = G.customer_snapshot_merge(hist, current)
    return hist


def scd2_version_accounting(spark, sf_dir):
    """Total / current versions, keys with history, most versions of a key."""
    per_key = Chain(spark, sf_dir).dim_customer.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_current").alias("c"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_versions"),
        F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("current_versions"),
        F.count_if(F.col("n") > 1).alias("changed_keys"),
        F.coalesce(F.max("n"), F.lit(0)).cast("bigint").alias("max_versions"),
    )


# ---- gold ---------------------------------------------------------------------

def _gold_table(table):
    def q(spark, sf_dir):
        return Chain(spark, sf_dir).gold[table]
    q.__doc__ = f"G: gold {table}"
    return q


def signup_versions(events: DataFrame) -> DataFrame:
    """Versions from ``signup`` events: one per signup, valid until the user's
    next signup (ordered by ts, event_id).  The successor is found per
    (user, hour) first, so a user with a huge share of signups is not one task."""
    s = events.where(F.col("event_type") == "signup").select("event_id", "user_id", "ts")
    s = next_in_key(s, key="user_id", ts="ts", tie="event_id",
                    bucket=F.date_trunc("hour", "ts"), out="valid_to")
    return s.select(F.col("event_id").alias("signup_event_id"), "user_id",
                    F.col("ts").alias("valid_from"), "valid_to")


def pit_events(spark, sf_dir):
    """J5 at microsecond grain: every purchase resolved to the signup version
    valid at its timestamp; purchases before a user's first signup stay null.

    A signup version lasts until the user's next signup, so the versions form
    a chain and the version valid at ``ts`` is the last signup at or before
    it: an as-of join, whose cost does not grow with signups per user (the
    window join of :func:`signup_versions` + ``pit_join`` would compare every
    purchase of a user with every signup of that user)."""
    ev = read_source(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    ev = ev.where(F.col("event_type").isin("purchase", "signup"))
    return asof_within(ev, key="user_id", ts="ts", is_start=F.col("event_type") == "signup",
                       tie="event_id", fact_cols=["event_id", "user_id", "ts", "value"],
                       versions={"signup_event_id": F.col("event_id")})


def pit_validity_audit(spark, sf_dir):
    """Resolved fact rows outside their version's window (must be 0)."""
    ch = Chain(spark, sf_dir)
    return validity_audit(ch.gold["fact_sales"], ch.dim_customer)


# ---- contracts ----------------------------------------------------------------

def _contract_kind(kind):
    def q(spark, sf_dir):
        silver = Chain(spark, sf_dir).silver
        suites = {t: [r for r in rules if r.kind == kind] for t, rules in C.SILVER_SUITES.items()}
        return C.suite_report(silver, {t: r for t, r in suites.items() if r})
    q.__doc__ = f"Q: silver contract rules of kind {kind}"
    return q


def bogus_segment_copy(customers: DataFrame) -> DataFrame:
    """Fault: the customer with the smallest id sent again with segment BOGUS."""
    first = customers.agg(F.min("customer_id")).scalar()
    bad = customers.where(F.col("customer_id") == first).withColumn("segment", F.lit("BOGUS"))
    return customers.unionByName(bad)


def contract_suite_report(spark, sf_dir):
    """Q5 on the clean silver and on silver with an injected BOGUS segment row.

    Only customers differ, so the rules of the other tables are evaluated once."""
    silver = StoredChain(spark, sf_dir).silver
    suites = dict(C.SILVER_SUITES)
    customers = {"customers": suites.pop("customers")}
    both = F.explode(F.array(F.lit("clean"), F.lit("bogus_segment"))).alias("variant")
    return _union([
        C.suite_report(silver, suites).select(both, "*"),
        C.suite_report(silver, customers).select(F.lit("clean").alias("variant"), "*"),
        C.suite_report({"customers": bogus_segment_copy(silver["customers"])}, customers).select(
            F.lit("bogus_segment").alias("variant"), "*")])


def model_test_report(spark, sf_dir):
    """DT1-DT5 over the gold tables."""
    return C.model_test_report(StoredChain(spark, sf_dir).gold)


def contract_faults(spark, sf_dir):
    """Q1-Q5 on silver with faults of every kind: each rule counts some."""
    return C.suite_report(faulty_silver(StoredChain(spark, sf_dir).silver))


def model_test_faults(spark, sf_dir):
    """DT1-DT5, J6 on gold with faults of every kind: each test counts some."""
    return C.model_test_report(faulty_gold(StoredChain(spark, sf_dir).gold))


def pit_validity_faults(spark, sf_dir):
    """J7 on a fact of which every eleventh line is misdated."""
    ch = Chain(spark, sf_dir)
    return validity_audit(misdated_fact(ch.gold["fact_sales"]), ch.dim_customer)


# ---- reconciliation -----------------------------------------------------------

def recon_metrics_q(spark, sf_dir):
    """R1-R5 metrics plus the check flags and ``ok``."""
    out = recon_checks(StoredChain(spark, sf_dir).recon())
    return out.select(*METRICS, *CHECKS, F.size("breaks").alias("n_breaks"), "ok")


def _first_ids(df: DataFrame, col: str, n: int) -> DataFrame:
    """The ``n`` smallest values of ``col`` (a top-k: at most n rows)."""
    return df.select(col).orderBy(col).limit(n)


def reopened(snap: DataFrame) -> DataFrame:
    """Fault: the first closed version of the first customer with one is open again."""
    closed = snap.where(F.col("valid_to").isNotNull())
    k = closed.agg(F.min("customer_id")).scalar()
    v = closed.where(F.col("customer_id") == k).agg(F.min("valid_from")).scalar()
    return snap.withColumn("valid_to", F.when(
        (F.col("customer_id") == k) & (F.col("valid_from") == v),
        F.lit(None).cast("timestamp_ntz")).otherwise(F.col("valid_to")))


def pit_reopened_sweep(spark, sf_dir):
    """J5 where some windows overlap: every order with the versions valid at its time."""
    ch = StoredChain(spark, sf_dir)
    orders = ch.staged["orders"].select("order_id", "customer_id", "order_ts")
    return sweep_join(orders, G.dim_customer(reopened(ch.snapshot)), "customer_id", "order_ts", ["customer_sk"],
                      bucket=lambda c: F.date_trunc("month", c))


def recon_variants(spark, sf_dir) -> dict[str, DataFrame]:
    """Metrics of the clean build and of one build per injected fault."""
    ch, early = stored_variants(spark, sf_dir)
    fact, dim, snap = ch.gold["fact_sales"], ch.dim_customer, ch.snapshot
    out = {"clean": ch.recon()}
    # delete three fact rows -> revenue and row count break
    out["drop_fact_rows"] = ch.recon(fact=fact.join(
        _first_ids(fact, "order_item_id", 3), "order_item_id", "left_anti"))
    # one cent more on one line -> revenue breaks only
    first = fact.agg(F.min("order_item_id")).scalar()
    out["nudge_amount"] = ch.recon(fact=fact.withColumn(
        "amount", F.when(F.col("order_item_id") == first,
                         (F.col("amount") + F.lit(0.01).cast("decimal(14,2)")).cast("decimal(14,2)"))
        .otherwise(F.col("amount"))))
    # one current dimension row lost, fact kept -> current count breaks
    cur_first = dim.where("is_current").agg(F.min("customer_id")).scalar()
    out["drop_current_dim_row"] = ch.recon(dim=dim.where(
        ~(F.col("is_current") & (F.col("customer_id") == cur_first))))
    # new customers' early orders kept -> unresolved keys
    out["early_new_orders"] = early.recon()
    # point-in-time join without the open-end coalesce -> unresolved keys
    out["no_open_end"] = ch.recon(fact=ch.fact_sales(open_upper=False))
    # reopen the first closed version -> two current versions, fan-out in the fact
    dim2 = G.dim_customer(reopened(snap))
    out["reopen_closed_version"] = ch.recon(fact=ch.fact_sales(dim=dim2), dim=dim2)
    return out


def recon_breaks(spark, sf_dir):
    """R6 under each injected fault: which checks break."""
    with settings(spark, stored.BUILD_CONF):   # the layers are written here
        variants = recon_variants(spark, sf_dir)
    return _union([recon_checks(m).select(F.lit(v).alias("variant"), *METRICS, *CHECKS,
                                          F.size("breaks").alias("n_breaks"), "ok")
                   for v, m in variants.items()])


def recon_swapped_amounts(spark, sf_dir):
    """R1, R2 by content: amounts exchanged between lines, which no total shows, found by digests."""
    ch = Chain(spark, sf_dir)
    lines = ch.staged["order_items"].select("order_item_id", line_amount("quantity", "unit_price").alias("amount"))
    return differing_rows(swapped_amounts(ch.gold["fact_sales"]), lines, "order_item_id", ["amount"])


# ---- inspection and the flagship ---------------------------------------------

def layer_inspect(spark, sf_dir):
    """(layer, table_name, rows) for every layer table.  Bronze versions
    are reported by ``bronze_version``; overwrite layers keep no history."""
    ch = StoredChain(spark, sf_dir)
    parts = []
    for layer, tables in (("bronze", ch.bronze), ("silver", ch.silver), ("gold", ch.gold)):
        for t, df in tables.items():
            parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(layer).alias("layer"), F.lit(t).alias("table_name"), "rows"))
    return _union(parts)


def revenue_by_status(spark, sf_dir):
    """Flagship: raw -> bronze -> silver -> SCD2 + point-in-time fact ->
    revenue and lines by order status."""
    fact = Chain(spark, sf_dir).gold["fact_sales"]
    return fact.groupBy("status").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("quantity").cast("bigint").alias("units"),
        F.sum("amount").cast("decimal(38,2)").alias("revenue"),
        F.count_if(F.col("customer_sk").isNull()).alias("unresolved"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_lineage_counts": bronze_lineage_counts,
    "bronze_history": bronze_history,
    "bronze_version": bronze_version,
    "silver_customers": _silver_table("customers"),
    "silver_products": _silver_table("products"),
    "silver_orders": _silver_table("orders"),
    "silver_order_items": _silver_table("order_items"),
    "silver_as_of": silver_as_of,
    "refine_stats": refine_stats,
    "staged_orders": staged_orders,
    "staged_items": staged_items,
    "scd2_rebuild": scd2_rebuild,
    "scd2_incremental": scd2_incremental,
    "scd2_version_accounting": scd2_version_accounting,
    "dim_customer": _gold_table("dim_customer"),
    "dim_product": _gold_table("dim_product"),
    "dim_date": _gold_table("dim_date"),
    "fact_sales": _gold_table("fact_sales"),
    "pit_events": pit_events,
    "pit_validity_audit": pit_validity_audit,
    "pit_reopened_sweep": pit_reopened_sweep,
    "contract_not_null": _contract_kind("not_null"),
    "contract_unique": _contract_kind("unique"),
    "contract_in_set": _contract_kind("in_set"),
    "contract_between": _contract_kind("between"),
    "contract_suite_report": contract_suite_report,
    "model_test_report": model_test_report,
    "contract_faults": contract_faults,
    "model_test_faults": model_test_faults,
    "pit_validity_faults": pit_validity_faults,
    "recon_metrics": recon_metrics_q,
    "recon_breaks": recon_breaks,
    "recon_swapped_amounts": recon_swapped_amounts,
    "layer_inspect": layer_inspect,
    "revenue_by_status": revenue_by_status,
    **stored.QUERIES,
}

__all__ = ["QUERIES", "Chain"]
