"""Tables stored bucketed and sorted by a key, so that joins and groupings on it need no exchange (K9)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.operators.sizing import row_width

#: bytes of a table's rows (by its schema's widths) in a bucket; a task that joins two takes some 300 MB
BUCKET_BYTES = 64 << 20


def bucket_count(*tables: DataFrame, least: int) -> int:
    """Buckets for tables that are joined on their key, so one number for all: ``BUCKET_BYTES`` each
    of the largest, ``least`` at least.  Each table's rows are counted, which runs its plan once."""
    size = max(df.agg(F.count(F.lit(1))).first()[0] * row_width(df.schema) for df in tables)
    return max(least, -(-size // BUCKET_BYTES))


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str) -> DataFrame:
    """``df`` as the catalog table ``name``, its files below ``path``, in ``buckets`` buckets of
    ``keys``, each one file sorted by them.  Tables of one number of buckets join on their keys
    without an exchange on either side; choose buckets by size (``bucket_count``), as one task
    sorts and writes a bucket."""
    by_bucket = df.repartition(buckets, *keys)       # the hash that buckets go by: one task writes a bucket
    by_bucket.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)
