"""Spark session defaults used by the jobs, the bench and the tests."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for every job in this package: AQE re-plans joins and
# partition counts from runtime statistics (so a join side that turns out small
# is broadcast only after Spark has measured it) and splits skewed join keys.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Let a join on (store, item, week) use inputs already hash-partitioned by
    # item, so the price join and all later series / item windows share one
    # shuffle (see prepare.join_prices).
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Each query checkpoints its daily fact table; let Spark delete those files
    # once the checkpointed data is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Folds of a cross-validation are fitted from threads, each in a pool of its own.
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "larder", extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the package defaults.

    ``master`` is only set when given, so a cluster submit keeps its own master.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if master and master.startswith("local"):
        # Local mode runs every task in the driver JVM.
        builder = builder.config("spark.driver.memory", os.environ.get("LARDER_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only when it is unset (local
    runs and tests) fall back to a fresh scratch folder under /tmp."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the setting
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
        return configured
    master = sc.master if sc is not None else ""
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="larder-ckpt-", dir=os.environ.get("LARDER_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    if sc is not None:
        sc.setCheckpointDir(local)
    return local
