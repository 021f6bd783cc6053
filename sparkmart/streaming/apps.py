"""Whole streaming applications over Kafka, wired like the original jobs.

They need the Kafka connector on the classpath (not available in the test
image); the plan functions they use are tested with file sources.
"""
from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from sparkmart.plans import transactions as T
from sparkmart.sources.kafka import read_kafka_stream, write_kafka_stream
from sparkmart.streaming import activity as SA
from sparkmart.streaming import transactions as ST
from sparkmart.streaming.supervisor import Starters


def transaction_starters(spark: SparkSession, servers: str, checkpoint_root: str, report_path: str,
                         topic_in: str = "transactions", topic_valid: str = "transactions_valid",
                         topic_dlq: str = "transactions_dlq", trigger: str = "15 seconds",
                         rules=None) -> Starters:
    """Valid topic, dead-letter topic and the one-minute window report, as three queries to be
    started, each with its own checkpoint (run them with ``streaming.supervisor``)."""
    def validated():
        return ST.validated_stream(read_kafka_stream(spark, servers, topic_in, "latest"), rules)

    def messages(valid: bool, topic: str, name: str):
        def start() -> StreamingQuery:
            v = validated()
            rows = v.filter(v["is_valid"] if valid else ~v["is_valid"])
            return write_kafka_stream(rows.select(*T.OUTPUT_COLUMNS), servers, topic, f"{checkpoint_root}/{name}")
        return start

    return {"valid": messages(True, topic_valid, "valid"), "dlq": messages(False, topic_dlq, "dlq"),
            "report": lambda: ST.start_window_report(validated(), report_path, f"{checkpoint_root}/report",
                                                     trigger=trigger, show=True)[0]}


def transaction_app(*args, **kwargs) -> dict[str, StreamingQuery]:
    """``transaction_starters``, started."""
    return {name: start() for name, start in transaction_starters(*args, **kwargs).items()}


def activity_app(spark: SparkSession, servers: str, checkpoint: str, counts_path: str,
                 topic: str = "events_topic", trigger: str = "5 seconds") -> StreamingQuery:
    """Per-key running event counts from the earliest offset on, checkpointed."""
    return SA.start_key_counts(read_kafka_stream(spark, servers, topic, "earliest"),
                               counts_path, checkpoint, trigger)
