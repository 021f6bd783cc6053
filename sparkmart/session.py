"""Session construction and shared-folder helpers.

Library functions never set session options themselves; a cluster job passes
its own session in.  ``build_session`` is what tests, the bench and local
runs use.
"""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def _driver_memory() -> str:
    """Up to 60% of physical memory, at most 8 GB (local mode: the driver is the executor)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    mb = max(1024, min(8192, int(total * 0.6) >> 20))
    return f"{mb}m"


def build_session(master: str = "local[*]", app: str = "sparkmart",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    cores = os.cpu_count() or 8
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 2 * cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # no broadcast from compile-time size estimates; explicit hints come after
        # a row-count check, and AQE broadcasts only after measuring a shuffle stage
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # streaming state (dedup keys, window counts) off-heap, with changelog checkpoints
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        # sessions of one key are merged in each task before they are shuffled
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        .config("spark.driver.memory", _driver_memory())
        # checkpoint files of collected DataFrames are removed, not left behind
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster-wide ``spark.checkpoint.dir``.

    The shared folder is read from the session.  Only when it is unset (local
    tests) a temporary folder is created and registered as the checkpoint dir.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = ensure_checkpoint_dir(spark)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return f"{base.rstrip('/')}/sparkmart/{name}/{uuid.uuid4().hex}"


def sizing_conf(input_bytes: int, executors: int, cores_per_executor: int,
                target_partition_bytes: int = 200 << 20) -> dict[str, str]:
    """Settings for a cluster run sized from the input volume.

    About ``target_partition_bytes`` per shuffle partition (AQE coalesces
    small ones and splits skewed ones), at least two waves of tasks over all
    cores, and scan splits of 256 MB so a task's input and its sort buffers
    fit in executor memory instead of spilling.
    """
    cores = max(1, executors * cores_per_executor)
    shuffle = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        # measured shuffle stages may still be broadcast (unset, it would be -1 too)
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The reliable-checkpoint folder: the session's ``spark.checkpoint.dir``
    (a temporary folder only for local runs where it is unset)."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server uses spark.checkpoint.dir itself
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="sparkmart-ckpt-")
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir()
