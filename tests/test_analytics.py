from conftest import rows
from sparkmart.plans import analytics as A


def _grades(spark):
    return spark.createDataFrame([(g, (g - 1) * 10, (g - 1) * 10 + 9) for g in range(1, 11)],
                                 "grade int, min_mark int, max_mark int")


def test_grade_report(spark):
    st = spark.createDataFrame([("Ann", 95), ("Bob", 70), ("Cy", 79), ("Di", 80), ("Ed", 120),
                                ("Fay", 0)], "name string, marks int")
    r = A.grade_report(st, _grades(spark))
    got = [tuple(x) for x in r.collect()]
    # grade desc (NULL last), name asc; names only above grade 7
    assert got == [("Ann", 10, 95), ("Di", 9, 80), ("Bob", 8, 70), ("Cy", 8, 79),
                   (None, 1, 0), (None, None, 120)]


def test_grade_seven_masked(spark):
    st = spark.createDataFrame([("Gus", 60), ("Hal", 69)], "name string, marks int")
    assert [tuple(r) for r in A.grade_report(st, _grades(spark)).collect()] == \
        [(None, 7, 60), (None, 7, 69)]


def test_range_join_bucketed_matches_nested_loop(spark):
    from sparkmart.operators.range_join import range_left_join
    import random
    rnd = random.Random(7)
    left = spark.createDataFrame([(i, rnd.uniform(-50, 1050)) for i in range(400)] + [(400, None)],
                                 "id int, v double")
    bands = spark.createDataFrame(
        [(b, lo, lo + rnd.uniform(0, 60)) for b, lo in enumerate(rnd.uniform(0, 1000) for _ in range(300))],
        "b int, lo double, hi double")
    nested = range_left_join(left, "v", bands, "lo", "hi", nested_loop_max_rows=10_000)
    bucketed = range_left_join(left, "v", bands, "lo", "hi", nested_loop_max_rows=0)
    assert rows(nested, "id", "b") == rows(bucketed, "id", "b")


def test_extent_distance(spark):
    st = spark.createDataFrame([(1.0, 5.0), (4.0, 1.0), (2.5, 3.25)], "lat_n double, long_w double")
    assert A.extent_distance(st).first()["distance"] == 7.0
    empty = spark.createDataFrame([], "lat_n double, long_w double")
    assert A.extent_distance(empty).first()["distance"] is None


def test_top_competitors(spark):
    hackers = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "hacker_id int, name string")
    diff = spark.createDataFrame([(1, 20), (2, 30)], "difficulty_level int, score int")
    ch = spark.createDataFrame([(10, 1), (11, 2), (12, 2)], "challenge_id int, difficulty_level int")
    subs = spark.createDataFrame([
        (1, 10, 20), (1, 11, 30),            # two full scores
        (2, 10, 20), (2, 10, 20), (2, 12, 30),  # same challenge twice counts: 3
        (3, 10, 20), (3, 11, 29),            # exactly one: excluded
    ], "hacker_id int, challenge_id int, score int")
    got = [tuple(r) for r in A.top_competitors(subs, hackers, ch, diff).collect()]
    assert got == [(2, "b"), (1, "a")]


def test_cheapest_per_group(spark):
    wands = spark.createDataFrame([
        (1, 1, 10, 5), (2, 2, 10, 5), (3, 1, 12, 5),  # tie on the minimum: both kept
        (4, 3, 1, 6), (5, 1, 7, 6),                   # cheapest is evil: next wins
    ], "id int, code int, coins_needed int, power int")
    props = spark.createDataFrame([(1, 20, 0), (2, 20, 0), (3, 20, 1)], "code int, age int, is_evil int")
    got = [tuple(r) for r in A.cheapest_per_group(wands, props).collect()]
    assert got[0] == (5, 20, 7, 6)
    assert sorted(got[1:]) == [(1, 20, 10, 5), (2, 20, 10, 5)]


def test_group_min_null_keys_like_window(spark):
    from pyspark.sql import Window, functions as F
    from sparkmart.operators.group_extreme import rows_at_group_min
    df = spark.createDataFrame([(None, 1, 3), (None, 1, 3), (None, 1, 4), (1, None, 2), (1, 1, None)],
                               "a int, b int, v int")
    w = df.withColumn("m", F.min("v").over(Window.partitionBy("a", "b"))) \
        .filter(F.col("v") == F.col("m")).drop("m")
    assert rows(rows_at_group_min(df, ["a", "b"], "v")) == rows(w)


def test_contest_leaderboard(spark):
    hackers = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "hacker_id int, name string")
    subs = spark.createDataFrame([
        (1, 7, 10), (1, 7, 30), (1, 8, 5),   # max per challenge: 30 + 5
        (2, 7, 35),                          # 35
        (3, 7, 0), (3, 8, 0),                # total 0: dropped
    ], "hacker_id int, challenge_id int, score int")
    got = [tuple(r) for r in A.contest_leaderboard(subs, hackers).collect()]
    assert got == [(1, "a", 35), (2, "b", 35)]


def test_range_join_one_very_wide_band(spark):
    from sparkmart.operators.range_join import range_left_join
    left = spark.createDataFrame([(1, 5.0), (2, 5e11), (3, -1.0)], "id int, v double")
    bands = spark.createDataFrame([(0, 0.0, 1e12)] + [(i, float(i), i + 0.5) for i in range(1, 400)],
                                  "b int, lo double, hi double")
    got = rows(range_left_join(left, "v", bands, "lo", "hi", nested_loop_max_rows=0), "id", "b")
    assert got == [(1, 0), (1, 5), (2, 0), (3, None)]
