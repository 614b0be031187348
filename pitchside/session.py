"""Session construction and the few session-aware helpers the library needs."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on.  AQE re-plans joins from real shuffle sizes
# (broadcasting small aggregates, splitting skewed partitions) and coalesces
# the many tiny post-aggregation partitions a few-teams workload produces.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "pitchside", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark (clusters bring their own)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared, fault-tolerant folder and is always
    respected; without it there is an error, as a machine's own disk would hold state that other
    machines need.  Only a local master (tests, the benchmark) gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir names no shared folder")
        current = scratch_dir("pitchside-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch_dir(prefix: str = "pitchside-") -> str:
    """Local scratch folder for tests only (never used for cluster output)."""
    return tempfile.mkdtemp(prefix=prefix, dir=os.environ.get("TMPDIR", "/tmp"))
