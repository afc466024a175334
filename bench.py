"""Benchmark: the daily batch over a stored lake plus headline registry queries.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8) and prints ONE JSON line:

    {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Pipeline stages mirror the reference's published stage timings (bronze append,
silver refine, gold build, reconcile) plus the contract gate; registry queries
run from the source tables and are materialised into Spark's ``noop`` sink,
so full results are computed without collecting them.

Before timing, the whole pipeline runs once on the smallest fixture
(``$BENCH_WARMUP_DIR``, default /root/testdata/sf0.001; set it empty to skip)
so one-time JVM class loading and code generation are not charged to the
first measured stage.  Nothing from the warm-up is reused: the timed run uses
a fresh lake and the requested data.

Lakes are created under ``$BENCH_LAKE_ROOT`` (any Hadoop URI; on a cluster
it must be a shared folder), default a fresh local temporary folder.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from stratalake import TABLES  # noqa: E402
from stratalake.plans.pipeline import Pipeline  # noqa: E402
from stratalake.plans.queries import QUERIES  # noqa: E402
from stratalake.session import build_session  # noqa: E402
from stratalake.sources import fixtures as fx  # noqa: E402
from stratalake.sources.lake import Lake  # noqa: E402

# ---- fixed values: the reference's published single-process stage results ----
REFERENCE_RATES = {"bronze_ingest": 281_813, "silver_refine": 214_233, "reconcile": 392_810}
REFERENCE_GOLD_SEC = 5.26
# --------------------------------------------------------------------------------

HEADLINE = ("revenue_by_status", "fact_sales", "scd2_rebuild", "silver_order_items",
            "pit_events", "recon_metrics", "contract_suite_report", "model_test_report")


def _lake_root(prefix: str) -> str:
    shared = os.environ.get("BENCH_LAKE_ROOT")
    if shared:
        return f"{shared.rstrip('/')}/{prefix}{time.time_ns()}"
    return tempfile.mkdtemp(prefix=prefix)


def _timed(out: dict, name: str, fn):
    t = time.perf_counter()
    res = fn()
    out[name] = round(time.perf_counter() - t, 3)
    return res


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        f"local[{cpus}]", app_name="stratalake-bench", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(cpus * 2, 8))),
        extra_conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g"),
                    "spark.sql.execution.arrow.pyspark.enabled": "true",
                    "spark.ui.showConsoleProgress": "false",
                    # local disk: opening a file is cheap, so small files are not
                    # packed into a few 4 MiB splits (the default assumes an
                    # object-store open); no effect on large files
                    "spark.sql.files.openCostInBytes": os.environ.get(
                        "BENCH_FILE_OPEN_COST", str(1 << 20))})
    spark.sparkContext.setLogLevel("ERROR")
    # warm the JVM: one untimed pipeline run on the smallest fixture
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warm and os.path.isdir(warm):
        wlake = Lake(_lake_root("stratalake-warmup-"))
        fx.land_extracts(spark, warm, wlake)
        Pipeline(spark, wlake).run([(d, fx.ingested_at(b)) for b, d in fx.BATCHES])
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()

    times: dict[str, float] = {}
    lake = Lake(_lake_root("stratalake-bench-"))
    pipe = Pipeline(spark, lake)

    def land():
        fx.land_extracts(spark, sf_dir, lake)

    _timed(times, "land_extracts", land)
    counts = _timed(times, "bronze_ingest", lambda: [pipe.ingest(d, fx.ingested_at(b))
                                                     for b, d in fx.BATCHES])
    bronze_rows = sum(sum(c.values()) for c in counts)
    _timed(times, "silver_refine", lambda: pipe.refine().collect())
    _timed(times, "contracts", pipe.validate)
    _timed(times, "gold_build", pipe.build_gold)
    recon = _timed(times, "reconcile", lambda: pipe.reconcile().first())
    if not recon["ok"]:
        raise SystemExit(f"reconciliation failed: {recon['breaks']}")

    for name in HEADLINE:
        # building the query counts too: reports store their layers while they are built
        _timed(times, f"q_{name}", lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())

    # incremental mode on the same landed extracts (reported apart, not in the total):
    # each ingest merges its batch into the newest-row state; one SCD2 merge per build
    inc: dict[str, float] = {}
    ipipe = Pipeline(spark, Lake(_lake_root("stratalake-bench-inc-")),
                     mode="incremental")
    from stratalake.sources.schemas import RAW
    for b, d in fx.BATCHES:
        raw = {t: lake.read_raw(spark, d, t, RAW[t]) for t in TABLES}
        _timed(inc, f"ingest_{b}", lambda: ipipe.ingest(d, fx.ingested_at(b), raw=raw))
        _timed(inc, f"refine_{b}", lambda: ipipe.refine().collect())
        _timed(inc, f"gold_{b}", ipipe.build_gold)
    irecon = _timed(inc, "reconcile", lambda: ipipe.reconcile().first())
    if not irecon["ok"] or irecon["fact_revenue"] != recon["fact_revenue"]:
        raise SystemExit(f"incremental run disagrees: {irecon['breaks']}")

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    rates = {
        "bronze_ingest": round(bronze_rows / times["bronze_ingest"]),
        "silver_refine": round(bronze_rows / times["silver_refine"]),
        "reconcile": round(recon["fact_rows"] / times["reconcile"]),
    }
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf.group(1)) if sf else sf_dir,
        "incremental": inc,
        # same denominators as the reference's published rates: bronze rows for
        # ingest and refine, fact rows for reconcile
        "rates_rows_per_sec": rates,
        "vs_reference": {
            **{k: round(v / REFERENCE_RATES[k], 2) for k, v in rates.items()},
            "gold_build": round(REFERENCE_GOLD_SEC / times["gold_build"], 2),
        },
        "bronze_rows": bronze_rows,
        "fact_rows": recon["fact_rows"],
        "revenue": str(recon["fact_revenue"]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
