"""Database extract (S5-S7).

``spark.read.jdbc`` with the incremental predicate handed to the database, and
a numeric key range split into partitions so large tables read in parallel.
No driver for a database is bundled; not exercised in the tests.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict,
              predicate: str | None = None, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None,
              num_partitions: int = 64) -> DataFrame:
    source = f"(SELECT * FROM {table} WHERE {predicate}) t" if predicate else table
    if partition_column is not None:
        return spark.read.jdbc(url, source, column=partition_column, lowerBound=lower,
                               upperBound=upper, numPartitions=num_partitions,
                               properties=properties)
    return spark.read.jdbc(url, source, properties=properties)
