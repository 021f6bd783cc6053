"""Column tests and guards (D1-D4, D6).

Each test returns one row ``(check_name, failures)`` where failures is the
number of rows the test query would return: NULL rows for not_null,
duplicated non-NULL values for unique, distinct non-NULL values outside the
list for accepted_values.  All are aggregates, computed partially per task.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _row(df: DataFrame, name: str, failures) -> DataFrame:
    return df.agg(F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures")) \
        .select(F.lit(name).alias("check_name"), "failures")


def not_null(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    return _row(df, name or f"not_null({col})", F.count_if(F.col(col).isNull()))


def unique(df: DataFrame, cols: str | Sequence[str], name: str | None = None) -> DataFrame:
    cols = [cols] if isinstance(cols, str) else list(cols)
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    dup = df.filter(present).groupBy(*cols).count().filter(F.col("count") > 1)
    return _row(dup, name or f"unique({','.join(cols)})", F.count(F.lit(1)))


def key_checks(df: DataFrame, col: str) -> DataFrame:
    """not_null and unique of one column from a single aggregation: rows per
    value (partial counts), where the NULL group's size is the not_null
    result and the non-NULL groups above one the unique result."""
    per_value = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    both = per_value.agg(
        F.coalesce(F.sum(F.when(F.col(col).isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("nn"),
        F.count_if(F.col(col).isNotNull() & (F.col("n") > 1)).cast("bigint").alias("uq"))
    return both.select(F.explode(F.array(
        F.struct(F.lit(f"not_null({col})").alias("check_name"), F.col("nn").alias("failures")),
        F.struct(F.lit(f"unique({col})").alias("check_name"), F.col("uq").alias("failures")))
    ).alias("c")).select("c.check_name", "c.failures")


def accepted_values(df: DataFrame, col: str, values: Sequence, name: str | None = None) -> DataFrame:
    bad = df.filter(~F.col(col).isin(list(values))).select(col).distinct()
    return _row(bad, name or f"accepted_values({col})", F.count(F.lit(1)))


def run_checks(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def require_rows(df: DataFrame, message: str = "no rows") -> DataFrame:
    """Raise on an empty input (reads at most one row); returns df unchanged."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def row_counts(**stages: DataFrame) -> DataFrame:
    """``(stage, rows)`` for several DataFrames in one job (union of counts)."""
    return reduce(DataFrame.unionByName, [
        d.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("stage"), "rows")
        for n, d in stages.items()])


def checks_from_spec(tables: dict[str, DataFrame], spec: dict) -> DataFrame:
    """Column tests declared per model, run as Spark aggregates.

    ``spec`` mirrors a model schema file::

        {"models": [{"name": "stg_payment",
                     "columns": [{"name": "payment_id", "tests": ["not_null", "unique"]}]},
                    {"name": "mart_customer_revenue",
                     "columns": [{"name": "kategori_customer", "tests": [
                         {"accepted_values": {"values": ["HIGH", "MEDIUM", "LOW"]}}]}]}]}

    ``accepted_values`` also takes ``{"arguments": {"values": [...]}}``.  Each
    check row is named ``<model>.<test>(<column>)``; not_null and unique of
    the same column share one aggregation.
    """
    out = []
    for model in spec.get("models", []):
        df, prefix = tables[model["name"]], model["name"] + "."
        checks = []
        for column in model.get("columns", []):
            col, tests = column["name"], column.get("tests", [])
            names = {t for t in tests if isinstance(t, str)}
            unknown = names - {"not_null", "unique"}
            if unknown:
                raise ValueError(f"unsupported tests on {model['name']}.{col}: {sorted(unknown)}")
            if {"not_null", "unique"} <= names:
                checks.append(key_checks(df, col))
            elif "not_null" in names:
                checks.append(not_null(df, col))
            elif "unique" in names:
                checks.append(unique(df, col))
            for t in tests:
                if isinstance(t, dict) and "accepted_values" in t:
                    args = t["accepted_values"] or {}
                    values = args.get("values") or args.get("arguments", {}).get("values", [])
                    checks.append(accepted_values(df, col, values))
        out += [c.select(F.concat(F.lit(prefix), F.col("check_name")).alias("check_name"),
                         "failures") for c in checks]
    if not out:
        raise ValueError("the spec declares no tests")
    return run_checks(*out)


def load_spec(path: str) -> dict:
    """Read a YAML schema file (needs PyYAML)."""
    try:
        import yaml
    except ImportError as e:  # pragma: no cover
        raise RuntimeError("PyYAML is needed to read a schema file") from e
    with open(path) as f:
        return yaml.safe_load(f)
