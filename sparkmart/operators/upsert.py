"""Set-based upsert: insert new keys, replace every non-key column of matched ones.

What ``INSERT ... ON DUPLICATE KEY UPDATE`` did one row at a time becomes one
plan: the last update per key (a partial aggregate, safe for hot keys), then
``target LEFT ANTI JOIN updates`` plus the updates.  A NULL in an update
overwrites; there is no per-column coalesce.  An empty update returns the
target unchanged.  The caller writes the result to a new location and swaps
(``sinks.files.write_version``); a path is never read and overwritten in one job.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.operators.per_key import last_per_key
from sparkmart.operators.sizing import is_small
from sparkmart.sinks.files import write_parquet


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           order_cols: Sequence[str], broadcast_keys_max: int = 2_000_000) -> DataFrame:
    """The last update per key is written once to the shared folder; its row
    count, read from there, decides whether the keys are broadcast (at most
    ``broadcast_keys_max``: the anti-join runs map-side and the large target is
    never shuffled) or both sides shuffle on the key."""
    missing = set(target.columns) ^ set(updates.columns)
    if missing:
        raise ValueError(f"target and updates differ in columns: {sorted(missing)}")
    spark = target.sparkSession
    latest = spark.read.parquet(write_parquet(
        last_per_key(updates.select(*target.columns), keys, order_cols), spark, "updates"))
    update_keys = latest.select(*keys)
    if broadcast_keys_max > 0 and is_small(update_keys, broadcast_keys_max):
        update_keys = F.broadcast(update_keys)
    kept = target.join(update_keys, list(keys), "left_anti")
    return kept.unionByName(latest)
