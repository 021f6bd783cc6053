"""Incremental extract -> transform -> upsert of customers, products, orders."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.text import format_phone, title_case
from sparkmart.operators.upsert import upsert

# fixed values: rows changed since one day before the run date are extracted
CHANGED_DAYS = 1


def _bound(df: DataFrame, col: str, as_of, days: int) -> Column:
    """``as_of - days`` as midnight, typed like the column so the predicate
    stays a plain comparison that reaches the Parquet / JDBC scan."""
    if as_of is None:
        day = F.current_date()
    elif isinstance(as_of, Column):
        day = as_of.cast("date")
    else:
        if isinstance(as_of, dt.datetime):
            as_of = as_of.date()
        day = F.lit(as_of).cast("date")
    return F.date_sub(day, days).cast(df.schema[col].dataType)


def changed_since(df: DataFrame, as_of=None, days: int = CHANGED_DAYS,
                  col: str = "updated_at") -> DataFrame:
    """Rows with ``col >= as_of - days`` (inclusive; NULL never passes)."""
    return df.filter(F.col(col) >= _bound(df, col, as_of, days))


def latest_value(df: DataFrame, col: str = "updated_at"):
    """The newest value of a column: one aggregate row read on the driver."""
    return df.agg(F.max(col)).first()[0]


def product_supplier_extract(products: DataFrame, suppliers: DataFrame, as_of=None,
                             days: int | None = CHANGED_DAYS) -> DataFrame:
    """Changed products with their supplier name; products without a supplier drop.
    ``days=None`` extracts every product (a full reload)."""
    p = products if days is None else changed_since(products, as_of, days)
    s = suppliers.select(F.col("id").alias("__sid"), "supplier_name")
    return (p.join(s, p["supplier_id"] == s["__sid"], "inner")
            .select("id", "product_name", "category", "price", "cost", "updated_at",
                    "supplier_name"))


def transform_customers(df: DataFrame) -> DataFrame:
    """Phone: ten digits -> (XXX) XXX-XXXX, else unchanged; state upper case.
    NULL phone and state stay NULL."""
    return df.withColumns({"phone": format_phone("phone"), "state": F.upper("state")})


def transform_orders(df: DataFrame) -> DataFrame:
    """Status lower case (NULL -> ''); amount NULL -> 0 and negatives -> 0."""
    amt = F.coalesce(F.col("total_amount"), F.lit(0).cast(df.schema["total_amount"].dataType))
    return df.withColumns({
        "status": F.lower(F.coalesce(F.col("status"), F.lit(""))),
        "total_amount": F.when(amt < 0, F.lit(0).cast(df.schema["total_amount"].dataType))
                         .otherwise(amt)})


def negative_amounts(df: DataFrame, id_col: str = "id", amount_col: str = "total_amount") -> DataFrame:
    """The anomaly report: every negative amount with its id (before clamping)."""
    return df.filter(F.col(amount_col) < 0).select(id_col, amount_col)


def transform_products(df: DataFrame) -> DataFrame:
    """Category in Title Case; margin_pct = (price - cost) / price * 100, NULL for a zero price."""
    return df.withColumns({
        "category": title_case("category"),
        "margin_pct": F.try_divide(F.col("price") - F.col("cost"), F.col("price")) * F.lit(100)})


def load_dimension(target: DataFrame, updates: DataFrame, key: str = "id",
                   order_cols=("updated_at",)) -> DataFrame:
    """Upsert by key; the last update per key wins (by ``order_cols``)."""
    return upsert(target, updates, [key], list(order_cols))


def unchanged_before(df: DataFrame, as_of=None, days: int = 1, col: str = "updated_at") -> DataFrame:
    """Rows with ``col < as_of - days``, or without a date (the state of a table as of that day)."""
    return df.filter(F.col(col).isNull() | (F.col(col) < _bound(df, col, as_of, days)))


def incremental_load(customers: DataFrame, products: DataFrame, suppliers: DataFrame,
                     orders: DataFrame, targets: dict[str, DataFrame], as_of=None,
                     days: int = CHANGED_DAYS) -> dict[str, DataFrame]:
    """The three extract -> transform -> upsert chains in one call.

    ``targets`` holds the current ``dim_customers``, ``dim_products`` and
    ``fact_orders``; the merged tables are returned for the caller to write to
    new locations (``sinks.files.write_version``).  An entity without changed
    rows keeps its target unchanged (the upsert of an empty update).
    """
    changed_c = transform_customers(changed_since(customers, as_of, days))
    changed_p = transform_products(product_supplier_extract(products, suppliers, as_of, days))
    changed_o = transform_orders(changed_since(orders, as_of, days))
    return {
        "dim_customers": load_dimension(targets["dim_customers"],
                                        changed_c.select(*targets["dim_customers"].columns)),
        "dim_products": load_dimension(targets["dim_products"],
                                       changed_p.select(*targets["dim_products"].columns)),
        "fact_orders": load_dimension(targets["fact_orders"],
                                      changed_o.select(*targets["fact_orders"].columns)),
    }
