"""A keyed table in buckets, of which an upsert rewrites only those it touches (K5-K7).

Rows lie in ``<root>/data/v=<version>/bucket=<hash of the key>``.  Each commit has
a manifest, one row per bucket with the version that holds it.  An upsert reads
the buckets of its updates, a partition filter of the scan, writes these below
its own version, and commits a manifest that names them; the files of all other
buckets stay as they are.  A manifest counts only once its commit is written
(``sinks.files.commit_version``), so readers see whole versions, and an upsert that
fails half-way leaves nothing but unnamed files.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from sparkmart.operators.upsert import upsert
from sparkmart.sinks.files import commit_version, current_version

BUCKET = "__bucket"


def _with_bucket(schema: StructType) -> StructType:
    return StructType([*schema, StructField(BUCKET, IntegerType())])


class BucketedTable:
    """``keys`` decide a row's bucket; ``buckets`` (fixed for the table's life) bounds the manifest."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), list(keys), buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _manifest(self, version: str) -> dict[int, str]:
        rows = self.spark.read.schema("b int, version string").parquet(f"{self.root}/manifest/m={version}").collect()   # ``buckets`` at most
        return {r["b"]: r["version"] for r in rows}

    def versions(self) -> dict[int, str]:
        """The version that holds each bucket; empty before the first commit."""
        version = current_version(self.spark, self.root)
        return self._manifest(version) if version else {}

    def _commit(self, held: dict[int, str], version: str) -> None:
        rows = self.spark.createDataFrame(sorted(held.items()), "b int, version string")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/m={version}")
        commit_version(self.spark, self.root, version)

    def _write(self, rows: DataFrame, version: str) -> list[int]:
        """Writes rows by bucket; the buckets that got rows.  What an attempt that was never
        committed has left below this version is replaced."""
        if version in set(self.versions().values()):
            raise ValueError(f"version {version} is committed already")
        path = f"{self.root}/data/v={version}"
        rows.withColumn(BUCKET, self._bucket()).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
        stored = self.spark.read.schema(_with_bucket(rows.schema)).parquet(path)
        return sorted(r[0] for r in stored.select(BUCKET).distinct().collect())     # ``buckets`` at most

    def create(self, rows: DataFrame, version: str) -> None:
        """The first version: all rows."""
        self.spark.createDataFrame([], rows.schema).write.mode("overwrite").parquet(f"{self.root}/schema")
        self._commit({b: version for b in self._write(rows, version)}, version)

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The current rows, of some ``buckets`` only if given: one scan, pruned by partition."""
        schema = self.spark.read.parquet(f"{self.root}/schema").schema
        held = {b: v for b, v in self.versions().items() if buckets is None or b in set(buckets)}
        if not held:
            return self.spark.createDataFrame([], schema)
        by: dict[str, list[int]] = {}
        for b, v in held.items():
            by.setdefault(v, []).append(b)
        out = None
        for v in sorted(by):                        # a scan for each version that still holds something
            part = self.spark.read.schema(_with_bucket(schema)).parquet(f"{self.root}/data/v={v}") \
                .where(F.col(BUCKET).isin(*sorted(by[v]))).drop(BUCKET)
            out = part if out is None else out.unionByName(part)
        return out

    def upsert(self, updates: DataFrame, order_cols: Sequence[str], version: str) -> list[int]:
        """Inserts and replaces by key; the last update of a key counts.  Returns the buckets that
        were rewritten, none for an empty update (which commits nothing)."""
        held, updates = self.versions(), updates.select(*self.read().columns)
        touched = sorted(r[0] for r in updates.select(self._bucket()).distinct().collect())      # ``buckets`` at most
        if not touched:
            return []
        self._write(upsert(self.read(touched), updates, self.keys, order_cols), version)
        self._commit(held | {b: version for b in touched}, version)
        return touched
