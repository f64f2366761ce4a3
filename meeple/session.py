"""Session settings and the shared working folder.

Library functions never build a session; tests, ``bench.py`` and scripts call
:func:`local_session`. On a cluster the session comes from the platform and only
:func:`shared_dir` is used, which reads ``spark.checkpoint.dir`` from the session.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package relies on (adaptive re-planning, skew splits, UTC).
CORE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def cluster_settings(shuffle_bytes: int, target_partition_bytes: int = 256 * 1024**2) -> dict[str, str]:
    """Settings for a cluster run that shuffles about ``shuffle_bytes``.

    The initial shuffle partition count is sized so that partitions hold about
    ``target_partition_bytes`` (adaptive execution then merges small ones and splits
    skewed ones). Scans read files in splits of the same size.
    """
    partitions = max(200, -(-shuffle_bytes // target_partition_bytes))
    return {
        **CORE_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, app: str = "meeple") -> SparkSession:
    """A local session for tests and benchmarks (UI off, adaptive execution on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("MEEPLE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in CORE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path under the cluster's shared ``spark.checkpoint.dir``.

    The folder named by the session wins. Where it is unset, a local session (one process,
    so one disk) gets a fresh folder, registered as the checkpoint dir so that later calls
    agree; a cluster has no folder that all executors share by default, so that is an error.
    """
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set (master {master}): name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="meeple-shared-"))
        base = spark.sparkContext.getCheckpointDir()
    base = base.rstrip("/")
    return "/".join([base, *parts]) if parts else base


def unique_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, never reused path below :func:`shared_dir`."""
    return shared_dir(spark, *parts, uuid.uuid4().hex)
