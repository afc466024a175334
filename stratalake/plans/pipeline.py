"""The daily batch over a stored lake (BR1, SV5, PL1-PL3, S12).

Every stage writes its layer and the next stage reads the written table, so
lineage is cut at each layer, a lost executor only re-runs tasks of the
current stage, and nothing is cached in memory.  Gates raise before the next
layer is written.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import TABLES
from ..operators import contracts as C
from ..functions.expressions import line_amount
from ..operators.reconcile import differing_rows, dimension_parts, fold_metrics, recon_checks, reconcile
from ..sources.lake import Lake, append_version, current_folder, footer_scan, table_version
from ..sources.schemas import BRONZE, EXTRACT_DATE, GOLD, INGESTED_AT, RAW, SILVER
from . import gold as G
from . import silver as S
from .bronze import conform_raw, ingest_stamp, stamp_lineage
from .incremental import MONTH, IncrementalState, concurrently, month_of

GOLD_TABLES = ("customer_snapshot", "dim_customer", "dim_product", "dim_date", "fact_sales")


class ReconciliationError(RuntimeError):
    """Raised when gold does not reconcile with silver."""


@dataclass
class Pipeline:
    """``mode="rebuild"`` recomputes silver and the SCD2 snapshot from all of
    bronze on every run (stateless, per-batch version history).
    ``mode="incremental"`` takes each batch, in whatever order batches come,
    into a state of newest rows and version chains, and builds only the months
    that it touches (see ``plans.incremental``).  All layers are identical in
    both modes."""

    spark: SparkSession
    lake: Lake
    mode: str = "rebuild"
    log: list = field(default_factory=list)

    def __post_init__(self):
        if self.mode not in ("rebuild", "incremental"):
            raise ValueError(f"unknown pipeline mode {self.mode!r}")

    # ---- bronze ------------------------------------------------------------
    def ingest(self, extract_date: str, ingested_at: str | None = None,
               raw: dict[str, DataFrame] | None = None) -> dict[str, int]:
        """BR1: append one day's extract of every table to bronze.

        ``raw`` defaults to the landing zone of ``extract_date``.  The ingest
        stamp is taken once for the whole batch.  Returns rows per table,
        counted from the written partition (no recomputation of the source)."""
        stamp = ingested_at or ingest_stamp()

        def one(t: str) -> int:
            src = raw[t] if raw is not None else self.lake.read_raw(self.spark, extract_date, t, RAW[t])
            src = conform_raw(src, t)
            # rows landed, counted by the write job itself (no second pass)
            seen = Observation()
            rows = stamp_lineage(src, extract_date, stamp).observe(
                seen, F.count(F.lit(1)).alias("rows"))
            self.lake.append(rows, self.lake.bronze_path(t), partition_by=[EXTRACT_DATE])
            return int(seen.get["rows"])

        counts = dict(zip(TABLES, concurrently(*[lambda t=t: one(t) for t in TABLES])))
        if self.mode == "incremental":
            self._advance_newest(extract_date, stamp)
        self.log.append(("ingest", extract_date, counts))
        return counts

    # ---- incremental state ---------------------------------------------------
    @property
    def state(self) -> IncrementalState:
        return IncrementalState(self.spark, self.lake)

    def _newest_path(self, table: str) -> str:
        return self.state.dimension_path(table)

    def _advance_newest(self, extract_date: str, stamp: str) -> None:
        """Take the batch just landed into the state, whatever its stamp; a lake
        without state starts from all of its bronze."""
        batch = {t: self.bronze(t) for t in TABLES}
        if self.state.started():
            batch = {t: df.where((F.col(EXTRACT_DATE) == F.lit(extract_date).cast("date"))
                                 & (F.col(INGESTED_AT) == F.lit(stamp).cast("timestamp_ntz")))
                     for t, df in batch.items()}
        self.state.advance(batch)

    def newest(self, table: str) -> DataFrame:
        return self.state.newest(table)

    def bronze(self, table: str) -> DataFrame:
        df = self.lake.read(self.spark, self.lake.bronze_path(table), BRONZE[table])
        return df.select(*BRONZE[table].fieldNames())

    # ---- silver ------------------------------------------------------------
    def silver(self, table: str) -> DataFrame:
        df = self.lake.read(self.spark, self.lake.silver_path(table), SILVER[table])
        return df.select(*SILVER[table].fieldNames())

    def serving(self, table: str) -> DataFrame:
        return self.lake.read(self.spark, self._serving_path(table), SILVER[table],
                              fmt="parquet")

    def _serving_path(self, table: str) -> str:
        # a parquet silver table already is the plain-parquet serving snapshot;
        # other formats get an exported copy
        if self.lake.fmt == "parquet":
            return self.lake.silver_path(table)
        return self.lake.serving_path(table)

    def refine(self) -> DataFrame:
        """SV5: write silver table by table; each later table reads the stored
        earlier ones (no recomputation of the cascade).  Independent tables
        are written concurrently.  Returns the kept/dropped report."""
        if self.mode == "incremental":
            return self._refine_months()
        bronze = {t: self.bronze(t) for t in TABLES}
        newest = {t: S.newest_rows(bronze[t], t) for t in TABLES}
        write = self._write_silver
        concurrently(lambda: write("customers", S.finish_customers(newest["customers"])),
                      lambda: write("products", S.finish_products(newest["products"])))
        write("orders", S.finish_orders(newest["orders"], self.silver("customers")))
        write("order_items", S.finish_order_items(
            newest["order_items"], self.silver("orders"), self.silver("products")))
        stats = S.refine_stats(bronze, {t: self.silver(t) for t in TABLES})
        self.log.append(("refine",))
        return stats

    def _write_silver(self, t: str, df: DataFrame) -> None:
        self.lake.overwrite(df, self.lake.silver_path(t))
        self._export(t)

    def _export(self, t: str) -> None:
        if self.lake.fmt != "parquet":
            self.lake.overwrite(self.silver(t), self.lake.serving_path(t), fmt="parquet")

    def _to_build(self, layer: str, *paths: str) -> tuple[list[str], set[str]]:
        """The unsettled marks of a layer and the months to build: the marked
        ones, or all where a table is not laid out by month yet."""
        marks, months = self.state.marked(layer)
        if not all(self.lake.partitioned(self.spark, p, MONTH) for p in paths):
            months = self.state.all_months()
        return marks, months

    def _replace_months(self, df: DataFrame, path: str, months: set[str]) -> None:
        if self.lake.partitioned(self.spark, path, MONTH):
            if months:
                self.lake.overwrite_partitions(df, path, MONTH, months)
        else:
            self.lake.overwrite(df, path, partition_by=[MONTH] if months else None)

    def _month_rows(self, path: str, schema, months: set[str]) -> DataFrame:
        return self.state.monthly(path, schema, months)

    def _refine_months(self) -> DataFrame:
        """SV1-SV5 of the months that the batches since the last build touch."""
        state, path = self.state, self.lake.silver_path
        marks, months = self._to_build("silver", path("orders"), path("order_items"))
        concurrently(lambda: self._write_silver("customers", S.finish_customers(state.newest("customers"))),
                      lambda: self._write_silver("products", S.finish_products(state.newest("products"))))
        self._replace_months(S.finish_orders(state.rows("orders", months), self.silver("customers"), (MONTH,)),
                             path("orders"), months)
        orders = self._month_rows(path("orders"), SILVER["orders"], months)
        self._replace_months(S.finish_order_items(state.rows("order_items", months), orders,
                                                  self.silver("products"), (MONTH,)),
                             path("order_items"), months)
        if months:
            state.account_silver(orders, self._month_rows(path("order_items"), SILVER["order_items"], months), months)
            for t in ("orders", "order_items"):
                self._export(t)
        state.mark(months, "gold")
        state.settle(marks)
        self.log.append(("refine", sorted(months)))
        return state.refine_stats({t: self.silver(t) for t in ("customers", "products")})

    # ---- contracts ---------------------------------------------------------
    def validate(self) -> DataFrame:
        """Q5 over the serving copy; raises :class:`ContractError` on failure."""
        report = C.suite_report({t: self.serving(t) for t in TABLES})
        failed = C.failed_rules(report)
        if failed:
            raise C.ContractError(f"silver contracts failed: {failed}")
        return report

    # ---- gold --------------------------------------------------------------
    def gold(self, table: str) -> DataFrame:
        if table == "customer_snapshot":
            return self.snapshot()
        df = self.lake.read(self.spark, self.lake.gold_path(table), GOLD[table])
        return df.select(*GOLD[table].fieldNames())

    def snapshot(self) -> DataFrame | None:
        """The SCD2 history.  Rebuild mode derives it from bronze on every
        build, so it is not stored twice: it is read back from ``dim_customer``
        (same rows, snapshot column names).  Incremental mode keeps the version
        chains as state; this returns the versions they stand for."""
        if self.mode == "rebuild":
            d = self.gold("dim_customer")
            return d.select("customer_id", "name", "segment", "city",
                            F.col("valid_from").alias("updated_at"),
                            F.col("customer_sk").alias("scd_id"), "valid_from", "valid_to")
        chain = self.state.chain()
        return None if chain is None else G.customer_snapshot(chain)

    def _write_dim_customer(self) -> None:
        snapshot = self.snapshot() if self.mode == "incremental" else \
            G.customer_snapshot_rebuild(self.bronze("customers"))
        self.lake.overwrite(G.dim_customer(snapshot), self.lake.gold_path("dim_customer"))

    def _fact_months(self) -> list[str]:
        """G4 of the months that the batches since the last build touch; returns the marks to settle."""
        silver, path = self.lake.silver_path, self.lake.gold_path("fact_sales")
        marks, months = self._to_build("gold", path)
        stg = {t: G.stage(self._month_rows(silver(t), SILVER[t], months), t) for t in ("orders", "order_items")}
        fact = G.fact_sales(stg["order_items"], stg["orders"], self.gold("dim_customer"))
        self._replace_months(fact.withColumn(MONTH, month_of(F.col("date_day"))), path, months)
        if months:
            self.state.account_fact(self._month_rows(path, GOLD["fact_sales"], months), months)
        return marks

    def build_gold(self) -> DataFrame:
        """Dims and fact, each written and read back; then the model tests
        gate the layer.  The customer chain (snapshot -> dim_customer -> fact)
        runs alongside the independent product and date dimensions."""
        silver = {t: self.silver(t) for t in TABLES}
        stg = G.stage_all(silver)
        w = lambda name, df: self.lake.overwrite(df, self.lake.gold_path(name))

        def customer_chain() -> list[str]:
            self._write_dim_customer()
            if self.mode == "incremental":
                return self._fact_months()
            w("fact_sales", G.fact_sales(stg["order_items"], stg["orders"],
                                         self.gold("dim_customer")))
            return []

        marks, *_ = concurrently(customer_chain,
                                 lambda: w("dim_product", G.dim_product(stg["products"])),
                                 lambda: w("dim_date", G.dim_date(stg["orders"])))
        report = C.model_test_report({t: self.gold(t) for t in GOLD_TABLES})
        failed = C.failed_rules(report)
        if failed:
            raise C.ContractError(f"gold model tests failed: {failed}")
        self.state.settle(marks)
        self.log.append(("gold",))
        return report

    # ---- reconcile ---------------------------------------------------------
    def reconcile(self, full: bool = True) -> DataFrame:
        """R6 on the stored layers; a one-row report.  ``full=False`` adds up the
        accounts of the months in place of reading the fact and the lines."""
        if self.mode == "incremental" and not full:
            total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,2)" if c == "revenue" else "long")
            return recon_checks(fold_metrics([
                self.state.fact_accounts().agg(total("revenue").alias("fact_revenue"), total("rows").alias("fact_rows"),
                                               total("unresolved").alias("unresolved_customer_sk")),
                self.state.silver_accounts().agg(total("revenue").alias("silver_revenue"),
                                                 total("items").alias("silver_items")),
                *dimension_parts(self.gold("dim_customer"), self.silver("customers"))]))
        return reconcile(self.gold("fact_sales"), self.silver("order_items"),
                         self.gold("dim_customer"), self.silver("customers"))

    def differing_lines(self) -> DataFrame:
        """R1, R2 by content: lines whose amount differs between the fact and silver, or which only one has."""
        lines = G.stage(self.silver("order_items"), "order_items").select(
            "order_item_id", line_amount("quantity", "unit_price").alias("amount"))
        return differing_rows(self.gold("fact_sales"), lines, "order_item_id", ["amount"])

    def export_fact(self) -> str:
        """The fact as a copy for readers outside, in ranges of the day; returns its folder."""
        path = self.lake.serving_path("fact_sales")
        self.lake.export(self.gold("fact_sales"), path, "date_day")
        return current_folder(self.spark, path)

    # ---- orchestration -----------------------------------------------------
    def run_day(self, extract_date: str, ingested_at: str | None = None,
                raw: dict[str, DataFrame] | None = None) -> None:
        """PL1: ingest -> refine -> validate (gate) -> gold + model tests (gate).

        The refine's kept and dropped rows of each table go to the log."""
        self.ingest(extract_date, ingested_at, raw)
        kept = {r.table_name: (r.kept, r.dropped) for r in self.refine().collect()}
        self.log.append(("kept/dropped", extract_date, kept))
        self.validate()
        self.build_gold()

    def run(self, days: list[tuple[str, str | None]]) -> dict:
        """PL2: every day in order, then reconciliation as the release gate."""
        for extract_date, stamp in days:
            self.run_day(extract_date, stamp)
        row = self.reconcile().first().asDict()
        if not row["ok"]:
            raise ReconciliationError("; ".join(row["breaks"]))
        return row

    # ---- inspection --------------------------------------------------------
    def inspect(self) -> DataFrame:
        """(layer, table_name, version, rows) for every stored table, from
        the file footers: no rows are read.  Versions of bronze are its appends."""
        nothing = F.lit(None).cast("bigint").alias("version")
        parts = []

        def add(layer: str, table: str, path: str) -> None:
            if not self.lake.exists(self.spark, path):
                return
            if layer == "bronze" and self.lake.fmt == "parquet":
                counted = append_version(self.spark, path)
            elif layer == "bronze":
                counted = table_version(self.bronze(table))
            elif self.lake.fmt == "parquet":
                counted = footer_scan(self.spark, path).agg(F.count(F.lit(1)).alias("rows")).select(nothing, "rows")
            else:
                counted = self.lake.read(self.spark, path).agg(F.count(F.lit(1)).alias("rows")).select(nothing, "rows")
            parts.append(counted.select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "version", "rows"))

        for t in TABLES:
            add("bronze", t, self.lake.bronze_path(t))
            add("silver", t, self.lake.silver_path(t))
        for t in GOLD_TABLES:
            # rebuild mode stores the snapshot as dim_customer; so many versions have the chains too
            add("gold", t, self.lake.gold_path("dim_customer" if t == "customer_snapshot" else t))
        if not parts:
            raise FileNotFoundError(f"no lake tables under {self.lake.root}")
        return reduce(lambda a, b: a.unionByName(b), parts)
