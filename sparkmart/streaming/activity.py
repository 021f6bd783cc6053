"""The keyed activity stream: per-key event count kept in checkpointed state.

Progress (offsets) and the counts live in the same checkpoint, so a restart
resumes both; at-least-once delivery into an idempotent per-batch sink.
"""
from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from sparkmart.plans import activity as A
from sparkmart.streaming.sinks import BatchFolderSink
from sparkmart.streaming.transactions import _trigger

#: state of several columns, as ``transformWithState`` keeps it, is only for RocksDB
STORE, ROCKSDB = ("spark.sql.streaming.stateStore.providerClass",
                  "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def start_key_counts(source: DataFrame, path: str, checkpoint: str,
                     trigger: str | None = "5 seconds", mode: str = "update", sink=None) -> StreamingQuery:
    """``mode="update"`` writes the keys changed in a micro-batch (output
    proportional to activity); ``"complete"`` writes the whole per-key map
    each time, as the original consumer printed it (output grows with the
    number of keys).  ``sink``: the ``foreachBatch`` sink, unless a folder per batch."""
    counts = A.key_event_counts(A.parse_activity(source))
    w = (counts.writeStream.outputMode(mode).foreachBatch(sink or BatchFolderSink(path))
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def read_key_counts(spark: SparkSession, path: str) -> DataFrame:
    """Latest count per key across the written micro-batches."""
    return (spark.read.parquet(path).groupBy("key")
            .agg(F.max_by("event_count", "batch_id").alias("event_count")))


def read_state_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(key, event_count) as the state holds them after the last committed batch."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(F.col("key.key").alias("key"), F.col("value.count").alias("event_count"))


def _running_count() -> StatefulProcessor:
    """One row per event, with the number of its key's events up to it.

    The state is a number per key.  A key's new events are put in log order and
    numbered on from it; they are (partition, offset) pairs, of one micro-batch,
    so the source's batch limit bounds them."""
    class RunningCount(StatefulProcessor):   # local, so that workers need not import this package
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.seen = handle.getValueState("seen", "n long")

        def handleInputRows(self, key, rows, timerValues) -> Iterator:
            import pandas as pd
            got = pd.concat(list(rows)).sort_values(["partition", "offset"], kind="stable", ignore_index=True)
            before = self.seen.get()[0] if self.seen.exists() else 0
            self.seen.update((before + len(got),))
            got["running_count"] = range(before + 1, before + len(got) + 1)
            # the same place in the log twice: both have the count after them, as in the batch plan
            got["running_count"] = got.groupby(["partition", "offset"], dropna=False)["running_count"].transform("max")
            yield got[["key", "partition", "offset", "running_count"]]

        def close(self) -> None:
            pass

    return RunningCount()


def running_counts(source: DataFrame) -> DataFrame:
    """The stream's (key, partition, offset, running_count), a row per event (needs RocksDB state: ``start_running_counts``)."""
    events = A.parse_activity(source).select("key", "partition", "offset")
    return events.groupBy("key").transformWithStateInPandas(
        _running_count(), "key string, partition int, offset long, running_count long", "append", "None")


def start_running_counts(source: DataFrame, path: str, checkpoint: str, trigger: str | None = "5 seconds") -> StreamingQuery:
    """What the original consumer printed after each event, appended as Parquet.
    The query keeps its state in RocksDB, whichever store the session names for others."""
    w = (running_counts(source).writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    conf = source.sparkSession.conf
    before = conf.get(STORE, None)
    conf.set(STORE, ROCKSDB)
    try:
        return _trigger(w, trigger).start()     # a started query has its own copy of the options
    finally:
        conf.unset(STORE) if before is None else conf.set(STORE, before)
