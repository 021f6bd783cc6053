"""Batch sinks (K1, K9, K5-K7 commit).

Files are written by the executors into the shared folder named by
``spark.checkpoint.dir`` unless a path is given; nothing is collected.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.session import scratch_dir


def write_parquet(df: DataFrame, spark: SparkSession, name: str, path: str | None = None,
                  partition_by: list[str] | None = None) -> str:
    path = path or scratch_dir(spark, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_version(df: DataFrame, root: str, version: str) -> str:
    """Write a new immutable version directory ``root/v=<version>``.

    Upserts never overwrite the path they read from: the merged table goes to
    a fresh version, and readers see it only after ``commit_version``.
    """
    path = f"{root.rstrip('/')}/v={version}"
    df.write.mode("errorifexists").parquet(path)
    return path


def commit_version(spark: SparkSession, root: str, version: str) -> None:
    """Make ``version`` the current one of all tables below ``root`` at once
    (a one-row file, added after all tables are written)."""
    spark.range(1).select(F.lit(version).alias("value")).coalesce(1).write.mode("append") \
        .text(f"{root.rstrip('/')}/commits")


def current_version(spark: SparkSession, root: str) -> str | None:
    """The last committed version (versions sort by time), None before the first."""
    try:
        return spark.read.text(f"{root.rstrip('/')}/commits").agg(F.max("value")).first()[0]
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_current(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table below ``root`` at its current version; a plain folder before the first commit."""
    version, path = current_version(spark, root), f"{root.rstrip('/')}/{table}"
    return spark.read.parquet(f"{path}/v={version}" if version else path)
