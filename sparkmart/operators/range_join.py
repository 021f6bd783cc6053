"""Left outer range join: ``left.v BETWEEN right.lo AND right.hi``.

Spark has no range-join strategy; a non-equi condition plans as a nested loop.
That is fine when the band table is tiny and broadcast (every left row is
compared with every band, so only a handful of bands).  Larger band tables are
joined by size class: a band whose width lies in (2**(c-1), 2**c] covers at
most three buckets of width 2**c, so one very wide band does not widen the
buckets of the narrow ones.  Each distinct left value is spread once over the
classes that occur and meets the bands of its buckets through an equi-join on
(class, bucket); the hits come back to the left rows by the value.  The result
is the same multiset as the nested loop, unmatched rows included.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.operators.sizing import broadcast_if_small, is_small

#: widths from 2**LEAST_CLASS to 2**MOST_CLASS have their own classes; narrower ones
#: share the first, wider and endless ones the last, which has a single bucket
LEAST_CLASS, MOST_CLASS = -20, 200


def _bucket(v, size_class):
    return F.when(size_class == MOST_CLASS, F.lit(0).cast("long")) \
        .otherwise(F.floor(v.cast("double") / F.pow(F.lit(2.0), size_class)))


def range_left_join(left: DataFrame, value_col: str, bands: DataFrame, lo_col: str,
                    hi_col: str, nested_loop_max_rows: int = 16,
                    broadcast_max_rows: int = 1_000_000) -> DataFrame:
    lo, hi = F.col(lo_col), F.col(hi_col)
    if is_small(bands, nested_loop_max_rows):
        return left.join(F.broadcast(bands), F.col(value_col).between(lo, hi), "left")

    width = (hi.cast("double") - lo.cast("double"))
    size_class = F.least(F.lit(MOST_CLASS), F.greatest(F.lit(LEAST_CLASS), F.ceil(F.log2(
        F.least(F.greatest(width, F.lit(2.0) ** (LEAST_CLASS - 1)), F.lit(2.0) ** MOST_CLASS))))).cast("int")
    spread = bands.where(lo <= hi).withColumn("__class", size_class) \
        .withColumn("__bucket", F.explode(F.sequence(_bucket(lo, F.col("__class")), _bucket(hi, F.col("__class")))))
    # at most MOST_CLASS - LEAST_CLASS + 1 numbers
    classes = sorted(r[0] for r in spread.select("__class").distinct().collect())
    spread, _ = broadcast_if_small(spread, broadcast_max_rows)
    values = left.select(F.col(value_col).alias("__v")).where(F.col("__v").isNotNull()).distinct()
    keyed = values.withColumn("__class", F.explode(F.array(*map(F.lit, classes)).cast("array<int>"))) \
        .withColumn("__bucket", _bucket(F.col("__v"), F.col("__class")))
    hits = keyed.join(spread, ["__class", "__bucket"]).where(F.col("__v").between(lo, hi)) \
        .select("__v", *bands.columns)
    return left.join(hits, left[value_col] == hits["__v"], "left").drop("__v")
