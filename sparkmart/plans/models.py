"""Layered models: staging view -> intermediate table -> revenue mart, and the
column tests declared on them."""
from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions.rules import band
from sparkmart.functions.text import full_name
from sparkmart.operators.quality import accepted_values, key_checks, run_checks

# fixed values: customer categories (also the accepted-values test), their
# thresholds (above 100 HIGH, 50 to 100 MEDIUM) and the mart's column names
CATEGORIES = ("HIGH", "MEDIUM", "LOW")
HIGH_ABOVE, MEDIUM_FROM = 100, 50
FULL_NAME_COLUMN, CATEGORY_COLUMN = "nama_lengkap", "kategori_customer"


def stg_payment(payment: DataFrame) -> DataFrame:
    """Projection, ``amount * 1.0`` (decimal stays decimal) and the date part."""
    return payment.select("payment_id", "customer_id", "staff_id", "rental_id", "amount",
                          (F.col("amount") * F.lit(Decimal("1.0"))).alias("amount_usd"),
                          F.col("payment_date").cast("date").alias("payment_date"))


def int_customer_payment(stg: DataFrame, customer: DataFrame) -> DataFrame:
    """Every customer with sum(amount) and count(payment_id); no payments ->
    NULL sum, 0 count.

    Payments are aggregated per customer before the outer join (partial
    aggregate; the join then sees one row per customer on each side).  The
    final group by the customer columns restores SQL's grouping if a customer
    id repeats, and needs no extra exchange.
    """
    pay = stg.groupBy("customer_id").agg(F.sum("amount").alias("total_amount"),
                                        F.count("payment_id").alias("total_transactions"))
    j = customer.select("customer_id", "first_name", "last_name").join(pay, "customer_id", "left")
    return j.groupBy("customer_id", "first_name", "last_name").agg(
        F.sum("total_amount").cast(pay.schema["total_amount"].dataType).alias("total_amount"),
        F.coalesce(F.sum("total_transactions"), F.lit(0)).cast("bigint").alias("total_transactions"))


def mart_customer_revenue(base: DataFrame, high: float = HIGH_ABOVE,
                          medium: float = MEDIUM_FROM) -> DataFrame:
    return base.select(
        "customer_id",
        full_name("first_name", "last_name").alias(FULL_NAME_COLUMN),
        "total_amount", "total_transactions",
        band("total_amount", high, medium, CATEGORIES).alias(CATEGORY_COLUMN))


def model_checks(stg: DataFrame, mart: DataFrame) -> DataFrame:
    """The declared tests: not_null + unique on payment_id, accepted values on the category."""
    return run_checks(key_checks(stg, "payment_id"),
                      accepted_values(mart, CATEGORY_COLUMN, CATEGORIES))


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """View materialization: recomputed on every read."""
    df.createOrReplaceTempView(name)
    return df


def materialize_table(spark: SparkSession, df: DataFrame, name: str, path: str) -> DataFrame:
    """Table materialization: written once (Parquet), later layers read the files."""
    df.write.mode("overwrite").parquet(path)
    t = spark.read.parquet(path)
    t.createOrReplaceTempView(name)
    return t


def build(spark: SparkSession, payment: DataFrame, customer: DataFrame, table_root: str,
          high: float = HIGH_ABOVE, medium: float = MEDIUM_FROM) -> tuple[DataFrame, DataFrame]:
    """All layers: staging as a view, intermediate and mart as tables under
    ``table_root``, then the declared tests.  Returns (mart, checks)."""
    stg = materialize_view(stg_payment(payment), "stg_payment")
    inter = materialize_table(spark, int_customer_payment(stg, customer), "int_customer_payment",
                              f"{table_root}/int_customer_payment")
    mart = materialize_table(spark, mart_customer_revenue(inter, high, medium),
                             "mart_customer_revenue", f"{table_root}/mart_customer_revenue")
    return mart, model_checks(stg, mart)
