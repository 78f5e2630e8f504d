"""Spark session construction and shared-folder helpers.

Every job in this package runs on whatever session the caller provides.
``build_session`` is the convenience used by tests, the bench and the
entry module: ANSI on (Spark 4 default), UTC session time zone, AQE with
partition coalescing and skew-join splitting, UI off.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def cluster_settings(shuffle_bytes: int = 100 * 2 ** 40, target_partition_bytes: int = 256 * 2 ** 20) -> dict:
    """Settings for a large cluster job, sized from the expected shuffle
    volume: enough shuffle partitions that each holds about
    ``target_partition_bytes`` (AQE then merges the small ones and splits
    skewed ones), and scan splits of 512 MB so a 100 TB scan is ~200k tasks
    rather than ~800k."""
    return {
        "spark.sql.shuffle.partitions": str(max(200, shuffle_bytes // target_partition_bytes)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(512 * 2 ** 20),
    }


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "tripwx", extra_conf: dict | None = None) -> SparkSession:
    """Local session for tests, the bench and the entry module; pass
    ``extra_conf=cluster_settings(...)`` (with a cluster master) for a
    large job."""
    master = master or os.environ.get("TRIPWX_MASTER", "local[*]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TRIPWX_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Python call-site capture on every Column call only feeds error messages
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in (extra_conf or {}).items():   # cluster settings override the local defaults
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets it to a shared file system; it is only
    filled in here when unset (local tests), never overridden.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            # a driver-local folder is invisible to executors: refuse to guess
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store) "
                               "before running tripwx jobs on a cluster")
        current = tempfile.mkdtemp(prefix="tripwx-ckpt-")
        atexit.register(shutil.rmtree, current, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tripwx-scratch/{label}-{uuid.uuid4().hex[:12]}"
