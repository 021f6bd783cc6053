"""Running row count per key: ``count(*) OVER (PARTITION BY key ORDER BY o)``.

A plain window puts every row of a key into one task, so a key with a third of
the data would sort that third on one core.  Instead the ordered rows are cut
into blocks (``block_cols``, non-decreasing along the order, e.g. the offset
divided by a block size):

1. rows per (key, block): a partial aggregate, one row per block;
2. rows in earlier blocks of the same key: a window over that small table;
3. those prefix rows are added to the data as one marker row per block, and a
   single windowed sum over (key, block) — at most one block of rows per task
   — gives prefix + rows so far.  The large input is shuffled once, and NULL
   keys group together as in PARTITION BY.

Peers (rows equal on the ordering) get the same count, as with the default
RANGE frame of SQL.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_count(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                  block_cols: Sequence[Column], out: str = "running_count") -> DataFrame:
    names = [f"__b{i}" for i in range(len(block_cols))]
    b = df.select("*", *[c.alias(n) for c, n in zip(block_cols, names)])

    per_block = b.groupBy(*keys, *names).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy(*names) \
        .rowsBetween(Window.unboundedPreceding, -1)
    prefix = per_block.select(*keys, *names,
                              F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__w"),
                              F.lit(0).alias("__marker"))
    data = b.select("*", F.lit(1).cast("bigint").alias("__w"), F.lit(1).alias("__marker"))
    both = data.unionByName(prefix, allowMissingColumns=True)
    upto = Window.partitionBy(*keys, *names).orderBy("__marker", *order_cols)
    return (both.withColumn(out, F.sum("__w").over(upto))
            .filter(F.col("__marker") == 1)
            .select(*df.columns, out))
