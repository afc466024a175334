"""SparkSession construction with the settings the engine relies on."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every session needs for correct results, regardless of cluster size.
REQUIRED_CONF = {
    # timestamps in the extracts are zone-less business times
    "spark.sql.session.timeZone": "UTC",
    # runtime re-planning: coalesce small shuffles, split skewed join partitions,
    # turn sort-merge into broadcast only when the *measured* side is small
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key's join partition even where that costs an extra shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # counts and bounds from Parquet footers, where a table is read by the newer file source
    "spark.sql.parquet.aggregatePushdown": "true",
    # a batch's keys, some millions, may filter the scan of a large table before its shuffle
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64MB",
}


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 128 * 1024 ** 2,
                           floor: int = 200, ceiling: int = 200_000) -> int:
    """Initial shuffle partition count for ``input_bytes`` of input.

    AQE only ever *merges* small shuffle partitions (toward
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``); it never splits a
    large one except for skewed joins.  So the initial count must be sized for
    the biggest shuffle: about one partition per 128 MB of input, e.g.
    ~800,000 for 100 TB before ceiling, which is why the ceiling exists
    (per-mapper block overhead); the default 200 would put ~500 GB in each."""
    n = -(-int(input_bytes) // int(target_bytes))
    return max(floor, min(ceiling, n))


def build_session(master: str | None = None, app_name: str = "stratalake",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session.

    ``master`` is only given for local runs and tests; on a cluster the
    launcher decides.  ``spark.checkpoint.dir`` is left alone when the cluster
    already names one; only a session without it gets a scratch folder.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(REQUIRED_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        # the initial count; AQE coalesces small partitions back down
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """The session with other settings for a while; those before come back, also after an error."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without one (tests, the local bench) gets a
    scratch folder of its own.  On a cluster a machine-local folder would be
    lost with its executor, so an unset folder stays unset (None); no plan of
    this package checkpoints, every layer is cut by writing it to the lake."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        return None
    local = tempfile.mkdtemp(prefix="stratalake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local
