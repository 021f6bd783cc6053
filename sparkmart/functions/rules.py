"""Conditional column expressions: masks, bands and first-match rule cascades."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def masked(value, condition: Column) -> Column:
    """``CASE WHEN condition THEN value END`` (NULL also when the test is NULL)."""
    return F.when(condition, _c(value))


def band(value, high: float, medium: float, labels=("HIGH", "MEDIUM", "LOW")) -> Column:
    """> high -> labels[0]; medium..high inclusive -> labels[1]; else (NULL too) labels[2]."""
    v = _c(value)
    return (F.when(v > F.lit(high), F.lit(labels[0]))
            .when(v.between(F.lit(medium), F.lit(high)), F.lit(labels[1]))
            .otherwise(F.lit(labels[2])))


def first_match(rules: Sequence[tuple[str, Column]]) -> Column:
    """Label of the first rule whose condition is true, else a typed NULL.

    A NULL condition counts as not matched, as in ``CASE WHEN``.
    """
    expr = None
    for label, cond in rules:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(None).cast("string")) if expr is not None \
        else F.lit(None).cast("string")
