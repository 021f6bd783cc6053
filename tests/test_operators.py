import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from sparkmart.operators import (broadcast_if_small, first_per_key, is_small, last_per_key,
                                 upsert)


def test_per_key_pick(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "b", 5), (2, "c", 1), (None, "d", 2), (None, "e", 9)],
                               "k int, v string, o int")
    assert rows(last_per_key(df, ["k"], ["o"])) == [(None, "e", 9), (1, "b", 5), (2, "c", 1)]
    assert rows(first_per_key(df, ["k"], ["o"])) == [(None, "d", 2), (1, "a", 3), (2, "c", 1)]


def test_per_key_matches_row_number_on_a_hot_key(spark):
    rnd = random.Random(1)
    data = [("hot" if rnd.random() < 0.5 else f"k{rnd.randrange(20)}", i, rnd.random()) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, seq int, x double")
    w = Window.partitionBy("k").orderBy(F.col("seq").desc())
    ref = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    assert rows(last_per_key(df, ["k"], ["seq"])) == rows(ref)


def test_size_check(spark):
    small = spark.range(10)
    assert is_small(small, 10) and not is_small(small, 9)
    _, used = broadcast_if_small(spark.range(100), 50)
    assert not used


def test_upsert_rejects_column_mismatch(spark):
    import pytest
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(ValueError):
        upsert(a, b, ["id"], ["id"])


def test_sizing_conf_for_100tb():
    from sparkmart.session import sizing_conf
    c = sizing_conf(100 * 2**40, executors=1000, cores_per_executor=8)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (200 << 20)
    assert int(sizing_conf(10 << 20, 2, 4)["spark.sql.shuffle.partitions"]) == 16


def test_pick_is_deterministic_on_ties(spark):
    data = [(1, f"v{i}", 5) for i in range(50)]
    a = spark.createDataFrame(data, "k int, v string, o int").repartition(7)
    b = spark.createDataFrame(list(reversed(data)), "k int, v string, o int").repartition(3)
    assert rows(last_per_key(a, ["k"], ["o"])) == rows(last_per_key(b, ["k"], ["o"]))
    assert rows(first_per_key(a, ["k"], ["o"])) == rows(first_per_key(b, ["k"], ["o"]))


def test_pick_with_a_map_column(spark):
    df = spark.createDataFrame([(1, {"a": 1}, 2), (1, {"b": 2}, 3)], "k int, m map<string,int>, o int")
    assert last_per_key(df, ["k"], ["o"]).first()["m"] == {"b": 2}
