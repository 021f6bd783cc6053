"""Where streams keep their state.

A session that names no store keeps all of it on the executors' heap, in two versions, and that
of a restarted query once more until the next maintenance; it grows until an executor ends.
"""
from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

from sparkmart.streaming.activity import ROCKSDB, STORE

_PREFIX = "spark.sql.streaming.stateStore."
PARTITIONS = "spark.sql.shuffle.partitions"

#: state on the executors' disks, and so much memory for all the stores of an executor together.
#: Written out and compacted with each batch: the next one's searches would else pass every key
#: that this one has removed (sessions that have ended), key by key
ON_DISK = {STORE: ROCKSDB,
           f"{_PREFIX}rocksdb.boundedMemoryUsage": "true",
           f"{_PREFIX}rocksdb.maxMemoryUsageMB": "64",
           f"{_PREFIX}rocksdb.allowFAllocate": "false",     # else 4 MB of disk a store are set aside
           f"{_PREFIX}rocksdb.changelogCheckpointing.enabled": "false",
           f"{_PREFIX}rocksdb.compactOnCommit": "true"}
#: stores of an operator, unless the cluster has more than half as many cores
STORES = 24


def state_on_disk(spark: SparkSession) -> dict[str, str]:
    """Options for queries of much state in few, large batches: ``ON_DISK``, in at most the
    session's number of partitions.  A store takes some MB of disk and memory whatever it holds,
    and one that lies on disk may be large, so there are as many as keep the cores busy."""
    stores = max(STORES, 2 * spark.sparkContext.defaultParallelism)
    return {**ON_DISK, PARTITIONS: str(min(stores, int(spark.conf.get(PARTITIONS))))}


@contextmanager
def state_kept(spark: SparkSession, options: Mapping[str, str]) -> Iterator[None]:
    """Queries that are started meanwhile have these options: a started query has its own copy
    of them, so the session's are put back."""
    before = {k: spark.conf.get(k, None) for k in options}
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
