"""Session set-up shared by the library, the tests and the bench.

Everything here is runtime configuration: the library never builds its own
cluster, it only adjusts the session it is handed.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every query relies on. UTC pins `timestamp_seconds`, `date_format`
# and `date_trunc`; ANSI makes a bad cast fail loudly, so parsing goes through
# `try_*` functions on purpose; AQE coalesces small shuffle partitions, splits
# skewed join partitions and turns joins into broadcasts from measured sizes.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "wattline", driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session. Partition count and driver memory stay as the cluster
    set them unless the caller (tests, bench) or WATTLINE_DRIVER_MEMORY asks for others."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    driver_memory = driver_memory or os.environ.get("WATTLINE_DRIVER_MEMORY")
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_root(spark: SparkSession) -> str:
    """Shared folder for written tables and lineage cuts.

    On a cluster this is whatever `spark.checkpoint.dir` names (a shared file
    system). Only when the session has none (a bare local test session) do we
    set one ourselves.
    """
    root = spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root:
            spark.sparkContext.setCheckpointDir(root)
            root = spark.sparkContext.getCheckpointDir()
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder on the shared file system")
        root = tempfile.mkdtemp(prefix="wattline-ckpt-")  # single-machine session only
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def fresh_location(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared root (one per written table)."""
    return f"{shared_root(spark)}/wattline/{name}-{uuid.uuid4().hex[:12]}"

