from pyspark.sql import functions as F

from conftest import rows
from sparkmart.functions import (band, first_match, format_phone, full_name, key_partition,
                                 lenient_int, masked, parse_date, title_case, try_double)


def test_band_edges(spark):
    df = spark.createDataFrame([(49.99,), (50.0,), (100.0,), (100.01,), (None,), (-1.0,)], "v double")
    got = rows(df.select("v", band("v", 100, 50).alias("b")))
    assert got == [(None, "LOW"), (-1.0, "LOW"), (49.99, "LOW"), (50.0, "MEDIUM"),
                   (100.0, "MEDIUM"), (100.01, "HIGH")]


def test_first_match_and_mask(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    rules = [("small", F.col("x") < 3), ("big", F.col("x") > 3)]
    got = rows(df.select("x", first_match(rules).alias("r"), masked("x", F.col("x") > 2).alias("m")))
    assert got == [(None, None, None), (1, "small", None), (5, "big", 5)]
    assert df.select(first_match([]).alias("r")).distinct().collect()[0]["r"] is None


def test_casts(spark):
    df = spark.createDataFrame([("2.9",), ("-0.5",), ("1e2",), ("abc",), ("99999999999",)], "s string")
    got = [r["i"] for r in df.select(lenient_int("s").alias("i")).collect()]
    assert got == [2, 0, 100, None, None]
    assert df.select(try_double("s").alias("d")).collect()[3]["d"] is None
    d = spark.createDataFrame([("2024-02-30",), ("2024-02-29",)], "s string")
    assert [r["d"] for r in d.select(parse_date("s").alias("d")).collect()][0] is None


def test_text(spark):
    df = spark.createDataFrame([("(555)123 4567", "ann", "lee", "hOME & gARDEN")], "p string, f string, l string, c string")
    r = df.select(format_phone("p").alias("p"), full_name("f", "l").alias("n"), title_case("c").alias("c")).first()
    assert (r["p"], r["n"], r["c"]) == ("(555) 123-4567", "ANN LEE", "Home & Garden")


def test_key_partition_range(spark):
    df = spark.createDataFrame([(f"k{i}",) for i in range(50)] + [(None,)], "k string")
    parts = [r["p"] for r in df.select(key_partition("k", 7).alias("p")).collect()]
    assert all(p is None or 0 <= p < 7 for p in parts) and parts[-1] is None
