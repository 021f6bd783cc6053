"""Size checks that guard explicit broadcasts.

Only inputs whose rows and bytes are proven below a bound are broadcast.  The
check is a count, one number per task; it runs the input's plan once, so it is
meant for literal and dimension tables and for tables written before (see
``operators.upsert``).  Bytes are rows times the schema's default width.  Sides
that come out of an aggregation are left to adaptive execution, which measures
the materialised shuffle and only then switches to a broadcast
(``spark.sql.adaptive.autoBroadcastJoinThreshold``).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, BinaryType, ArrayType, MapType, StructType

MAX_BYTES = 256 << 20


def row_width(kind: DataType) -> int:
    """Rough bytes of a value: 8, texts 64, nested ones by their parts."""
    if isinstance(kind, StructType):
        return sum(row_width(f.dataType) for f in kind.fields) + 8
    if isinstance(kind, (ArrayType, MapType)):
        return 256
    return 64 if isinstance(kind, (StringType, BinaryType)) else 8


def is_small(df: DataFrame, max_rows: int, max_bytes: int = MAX_BYTES) -> bool:
    rows = df.agg(F.count(F.lit(1))).first()[0]
    return rows <= max_rows and rows * row_width(df.schema) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> tuple[DataFrame, bool]:
    """``(broadcast(df), True)`` when df has at most ``max_rows`` rows, else ``(df, False)``."""
    if is_small(df, max_rows):
        return F.broadcast(df), True
    return df, False
