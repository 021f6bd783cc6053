"""The small extract/transform/load task chain."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.operators.quality import require_rows

# fixed values: the sample records of the extract step and the tax factor
SAMPLE_RECORDS = [{"name": "apple", "price": 10}, {"name": "banana", "price": 5}]
TAX_RATE = 1.1


def extract_task(spark: SparkSession, records=None) -> DataFrame:
    """In-memory records (list of dicts) as a DataFrame with an explicit schema."""
    data = SAMPLE_RECORDS if records is None else records
    return spark.createDataFrame([(r["name"], r["price"]) for r in data], "name string, price int")


def price_with_tax(df: DataFrame, rate: float = TAX_RATE) -> DataFrame:
    """Upper-case name, keep price, add price * rate.  Empty in, empty out."""
    return df.select(F.upper("name").alias("name"), "price",
                     (F.col("price") * F.lit(rate)).alias("price_with_tax"))


def transform_task(df: DataFrame) -> DataFrame:
    """The transform step refuses an empty input."""
    return price_with_tax(require_rows(df, "No data received from extract_task"))


def load_task(df: DataFrame, path: str) -> str:
    """The load step refuses empty data, then writes on the executors."""
    require_rows(df, "No transformed data found")
    df.write.mode("overwrite").parquet(path)
    return path
