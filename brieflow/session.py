"""Spark session helpers.

The library never hard-codes cluster settings. ``get_session`` is a
convenience for tests, the bench and the examples; on a cluster the
caller's session is used as is, and only the settings the library
depends on for *correct* results (UTC session time zone) are checked.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # local mode only: the driver JVM is the executor too
    "spark.driver.memory": "12g",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "brieflow", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage; we read it
    and never override it. Only where it is unset (local tests) a fresh
    scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="brieflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    import uuid
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


#: rows up to which a small side is broadcast
BROADCAST_ROWS = 100_000


def broadcast_if_small(df, most: int = BROADCAST_ROWS):
    """``df`` marked for broadcast if it has at most ``most`` rows (looked up here), else as it is."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
