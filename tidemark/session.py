"""Session helpers.

The library never creates a session behind the caller's back; these helpers are
for tests, the benchmark and local runs. On a cluster the session comes from the
platform and only `ensure_checkpoint_dir` / `apply_defaults` are used.
"""

from __future__ import annotations

import atexit
import os
import shutil
import sys
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so that epoch seconds, hour and day of week
# do not depend on the machine, AQE for runtime coalescing / skew splitting, and rank
# limits (k smallest per group) up to 10,000 applied before the shuffle.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime settings the operators assume (idempotent)."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the benchmark (UI off, no server)."""
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    os.environ.setdefault("PYSPARK_DRIVER_PYTHON", sys.executable)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint folder named by the cluster.

    `spark.checkpoint.dir` is read from the session. Only when it is unset on a
    local master (tests, the benchmark) is a fresh scratch folder created,
    registered, and removed when the process ends; on a cluster an unset folder
    is an error. Sessions without a SparkContext (Spark Connect) keep the
    server's setting.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the folder
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
