"""Keyed activity events: per-key counts, running count in log order and the
key -> partition assignment."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from sparkmart.functions.partition import key_partition
from sparkmart.operators.running import running_count

# fixed values of the activity contract
ACTIVITY_SCHEMA = StructType([
    StructField("timestamp", LongType(), True),
    StructField("action", StringType(), True),
    StructField("amount", IntegerType(), True),
])
PARTITIONS = 3


def parse_activity(kafka: DataFrame) -> DataFrame:
    """Record metadata (partition, offset, key) plus the decoded value; the
    epoch-seconds field becomes ``event_time``."""
    d = F.from_json(F.col("value").cast("string"), ACTIVITY_SCHEMA)
    have = set(kafka.columns)
    part = F.col("partition") if "partition" in have else F.lit(None).cast("int")
    off = F.col("offset") if "offset" in have else F.lit(None).cast("long")
    return kafka.select(part.alias("partition"), off.alias("offset"),
                        F.col("key").cast("string").alias("key"), d.alias("d")) \
        .select("partition", "offset", "key", "d.*") \
        .withColumn("event_time", F.timestamp_seconds("timestamp"))


def key_event_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("key").agg(F.count(F.lit(1)).alias("event_count"))


def key_running_count(events: DataFrame, block_size: int = 1 << 20) -> DataFrame:
    """Count of the key's events up to and including this one, in log order
    (partition, offset), computed block-wise so a hot key is spread out."""
    return running_count(events, ["key"], ["partition", "offset"],
                         [F.col("partition"), F.floor(F.col("offset") / F.lit(block_size))])


def assign_partitions(df: DataFrame, key: str = "key", partitions: int = PARTITIONS) -> DataFrame:
    return df.withColumn("partition", key_partition(key, partitions))


def keyed_json(df: DataFrame, key: str, value_cols) -> DataFrame:
    """Producer side: key text + JSON of the value columns (for a Kafka sink)."""
    return df.select(F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*value_cols)).alias("value"))


def order_like_log(df: DataFrame, partitions: int = PARTITIONS, key: str = "key") -> DataFrame:
    """Rows laid out the way the log holds them: all rows of a key in one task
    (hash of the log partition), ordered by (partition, offset) inside it, so a
    per-partition consumer sees each key's events in order.  Computes the
    partition from the key when the column is absent."""
    if "partition" not in df.columns:
        df = assign_partitions(df, key, partitions)
    return df.repartition(partitions, "partition").sortWithinPartitions("partition", "offset")
