"""Session settings shared by jobs, tests and the bench.

Dates and devices are UTC by convention, so the session time zone is
pinned. Adaptive execution re-plans joins and shuffle sizes at run time
and splits skewed join partitions.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key's join partition even when the aggregate after the
    # join then needs its own (small, map-side-combined) shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "cohortloom", extra: dict | None = None) -> SparkSession:
    """Return a session with the library's settings.

    ``master`` is left to spark-submit when None. On a cluster, size
    ``shuffle_partitions`` so one reduce partition stays near 128-256 MB.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(key, conf[key])
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the cluster's checkpoint folder, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is
    used as is. Only when it is unset is ``fallback`` set, which tests and
    local runs pass; without one this raises, since a machine-local folder
    would lose rows on a cluster.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not fallback:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = fallback
        os.makedirs(configured, exist_ok=True)
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's checkpoint folder. A local master
    without one gets a folder of its own, since all its tasks share it."""
    sc = spark.sparkContext
    local = sc.master.startswith("local") and "cluster" not in sc.master
    base = sc.getConf().get("spark.checkpoint.dir") or ensure_checkpoint_dir(
        spark, tempfile.mkdtemp(prefix="cohortloom-ckpt-") if local and not sc.getCheckpointDir() else None)
    return f"{base.rstrip('/')}/cohortloom-{name}-{uuid.uuid4().hex}"
