"""Rows that hold the minimum of a value within their group, ties kept.

Equivalent to ``min(v) OVER (PARTITION BY g) = v``, but without funnelling a
whole group into one window task: the minimum is a partial (map-side)
aggregate that shrinks to one row per group, and the rows are matched back by
an equi-join on (group, value).  The per-group table is small whenever the
group count is; adaptive execution turns that join into a broadcast after
measuring it.  Group keys compare NULL-safe, as PARTITION BY does.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_at_group_min(df: DataFrame, group_cols: Sequence[str], value_col: str) -> DataFrame:
    mins = (df.groupBy(*group_cols).agg(F.min(value_col).alias("__min"))
            .select(*[F.col(g).alias(f"__g_{g}") for g in group_cols], "__min"))
    cond = [df[g].eqNullSafe(mins[f"__g_{g}"]) for g in group_cols]
    cond.append(df[value_col] == mins["__min"])
    return df.join(mins, cond, "inner").select(*[df[c] for c in df.columns])
