"""File and catalog readers (S1, S2, S8, S9)."""
from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

REJECTED = "_rejected"


def read_csv_strings(spark: SparkSession, path: str,
                     columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with a header, every column read as text; no inference pass.

    Without ``columns`` the names come from the header (only the first line is
    read for them); with ``columns`` that schema is declared up front.  Typing
    happens later with ``try_cast`` so a bad cell becomes NULL instead of
    failing the job.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if columns is None:
        return reader.option("inferSchema", False).csv(path)
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    return reader.schema(schema).csv(path)


def csv_headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files below ``path`` by their header; files of no line are left out."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
                                         F.monotonically_increasing_id().alias("row"))
    heads = lines.where("at = 0").groupBy("file").agg(F.min_by("value", "row").alias("head"))
    out: dict[tuple[str, ...], list[str]] = {}
    for r in sorted(heads.collect()):       # a file's name and header each
        out.setdefault(tuple(next(csv.reader([r["head"].removeprefix("\ufeff")]))), []).append(r["file"])
    return out


def read_csv_checked(spark: SparkSession, path: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected lines) of the CSV files below ``path``, every column as text.

    Columns go by each file's own header, so files may order them differently, hold
    others too (left out) or lack some (NULL there).  A line whose number of cells is not
    its header's, or with an open quote, is no row: it comes back as it stands, as
    ``line``.  A doubled quote inside quotes is a quote; a quote that opens in a line's last
    cell and never closes is part of that cell.  Spark checks the header against the order that is read
    (``enforceSchema=false``) and keeps such lines (``columnNameOfCorruptRecord``).  The files
    are parsed once, with all their cells, into the shared folder: parsed for some columns
    only, lines would pass that are broken elsewhere.
    """
    from sparkmart.sinks.files import write_parquet
    parts = []
    for head, files in csv_headers(spark, path).items():
        if len(set(head)) < len(head):
            raise ValueError(f"a column stands twice in the header of {files[0]}: {head}")
        schema = StructType([StructField(c, StringType(), True) for c in (*head, REJECTED)])
        got = (spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("escape", '"').option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", REJECTED).csv(files))
        whole = spark.read.parquet(write_parquet(got, spark, "csv_parsed"))
        parts.append(whole.select(*((F.col(f"`{c}`") if c in head else F.lit(None).cast("string")).alias(c) for c in columns), REJECTED))
    if not parts:
        parts.append(spark.createDataFrame([], StructType([StructField(c, StringType(), True) for c in (*columns, REJECTED)])))
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.where(F.col(REJECTED).isNull()).drop(REJECTED), both.where(F.col(REJECTED).isNotNull()).select(F.col(REJECTED).alias("line"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Named source table or upstream model (registered table or temp view)."""
    return spark.table(name)
