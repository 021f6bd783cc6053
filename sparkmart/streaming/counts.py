"""Row counts of running streams, batch by batch (A9, D6 on streams).

``counted`` marks where rows are counted, with ``observe``: nothing is read
twice.  ``BatchCounts`` listens to the progress of all queries of the session
and writes one small JSON table per batch; a batch that runs again replaces its
counts.
"""
from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = "counts map<string, long>, input long, dropped_by_watermark long, state_rows long"


def counted(df: DataFrame, name: str, **conditions: Column) -> DataFrame:
    """``df``, with the rows that meet each condition counted under its name."""
    return df.observe(name, *(F.count(F.when(c, 1)).alias(k) for k, c in conditions.items()))


class BatchCounts(StreamingQueryListener):
    """Writes ``<path>/stream=<query name>/batch_id=<n>``; only named queries are listed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def __enter__(self) -> BatchCounts:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the counts of an ended query are written: its end is reported after its progress."""
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError(f"no end of {query.name} was reported")

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not p.name:
            return
        got = {k: int(v) for row in p.observedMetrics.values() for k, v in row.asDict().items()}
        ops = p.stateOperators
        row = (got, p.numInputRows, sum(o.numRowsDroppedByWatermark for o in ops), sum(o.numRowsTotal for o in ops))
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("overwrite") \
            .json(f"{self.path}/stream={p.name}/batch_id={p.batchId}")

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """(stream, batch_id, counts, input, dropped_by_watermark, state_rows)."""
    return spark.read.schema(SCHEMA + ", stream string, batch_id long").json(path)


def total_counts(spark: SparkSession, path: str) -> DataFrame:
    """(stream, name, rows): each count over all batches, with the rows the watermark dropped."""
    c = read_counts(spark, path)
    dropped = F.create_map(F.lit("dropped_by_watermark"), "dropped_by_watermark")
    return c.select("stream", F.explode(F.map_concat("counts", dropped)).alias("name", "n")) \
        .groupBy("stream", "name").agg(F.sum("n").alias("rows"))
