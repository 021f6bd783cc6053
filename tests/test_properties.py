"""Property tests: the scale-safe operators equal their naive definitions."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from sparkmart.operators import first_per_key, rows_at_group_min, running_count, upsert
from sparkmart.operators.range_join import range_left_join

SETTINGS = settings(max_examples=8, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
small_int = st.one_of(st.none(), st.integers(0, 3))


@SETTINGS
@given(st.lists(st.tuples(small_int, st.integers(0, 40)), min_size=1, max_size=40),
       st.integers(1, 6))
def test_running_count_equals_window(spark, data, block):
    df = spark.createDataFrame([(k, o) for k, o in data], "k int, o int")
    got = running_count(df, ["k"], ["o"], [F.floor(F.col("o") / F.lit(block))])
    ref = df.withColumn("running_count", F.count(F.lit(1)).over(Window.partitionBy("k").orderBy("o")))
    assert rows(got) == rows(ref)


@SETTINGS
@given(st.lists(st.tuples(small_int, small_int, st.one_of(st.none(), st.integers(0, 5))),
                min_size=1, max_size=30))
def test_group_min_equals_window(spark, data):
    df = spark.createDataFrame(data, "a int, b int, v int")
    ref = df.withColumn("m", F.min("v").over(Window.partitionBy("a", "b"))) \
        .filter(F.col("v") == F.col("m")).drop("m")
    assert rows(rows_at_group_min(df, ["a", "b"], "v")) == rows(ref)


@SETTINGS
@given(st.lists(st.floats(-10, 110, allow_nan=False), min_size=1, max_size=30),
       st.lists(st.tuples(st.floats(0, 100, allow_nan=False), st.floats(0, 30, allow_nan=False)),
                min_size=1, max_size=20))
def test_range_join_paths_agree(spark, values, bands):
    left = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    b = spark.createDataFrame([(j, lo, lo + w) for j, (lo, w) in enumerate(bands)],
                              "b int, lo double, hi double")
    nested = range_left_join(left, "v", b, "lo", "hi", nested_loop_max_rows=10_000)
    bucketed = range_left_join(left, "v", b, "lo", "hi", nested_loop_max_rows=0)
    assert rows(nested, "id", "b") == rows(bucketed, "id", "b")


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9)), max_size=15, unique_by=lambda t: t[0]),
       st.lists(st.tuples(st.integers(0, 8), st.integers(0, 9), st.integers(0, 100)), max_size=15,
                unique_by=lambda t: (t[0], t[2])))
def test_upsert_equals_dictionary_merge(spark, target, updates):
    t = spark.createDataFrame(target, "id int, v int")
    u = spark.createDataFrame(updates, "id int, v int, seq int")
    merged = upsert(t.withColumn("seq", F.lit(-1)), u, ["id"], ["seq"]).drop("seq")
    expect = dict(target)
    for k, v, _ in sorted(updates, key=lambda x: x[2]):
        expect[k] = v
    assert rows(merged) == sorted(expect.items())


@SETTINGS
@given(st.lists(st.tuples(small_int, st.integers(0, 50)), min_size=1, max_size=30, unique_by=lambda t: t[1]))
def test_first_per_key_equals_row_number(spark, data):
    df = spark.createDataFrame(data, "k int, o int")
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("o"))) \
        .filter("rn = 1").drop("rn")
    assert rows(first_per_key(df, ["k"], ["o"])) == rows(ref)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 4), st.one_of(st.none(), st.integers(0, 6)),
                          small_int), min_size=1, max_size=40),
       st.lists(st.tuples(st.integers(0, 4), small_int, st.integers(0, 1)), min_size=1, max_size=8))
def test_cheapest_per_group_equals_window(spark, wands, props):
    from sparkmart.plans.analytics import cheapest_per_group
    w = spark.createDataFrame(wands, "id int, code int, coins_needed int, power int")
    p = spark.createDataFrame(props, "code int, age int, is_evil int")
    j = w.join(p.filter("is_evil = 0"), "code")
    ref = (j.withColumn("m", F.min("coins_needed").over(Window.partitionBy("age", "power")))
           .filter(F.col("coins_needed") == F.col("m")).select("id", "age", "coins_needed", "power"))
    assert rows(cheapest_per_group(w, p, broadcast_max_rows=5)) == rows(ref)


@settings(max_examples=3, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 4),                       # user
                          st.integers(-50, 400),                   # amount
                          st.sampled_from(["mobile", "web", "pos", "atm", None]),
                          st.integers(0, 300),                     # lag seconds
                          st.booleans()),                          # delivered twice
                min_size=5, max_size=40),
       st.integers(1, 4))
def test_stream_equals_batch_on_random_feeds(spark, msgs, files):
    import datetime as dt
    import json
    import os
    import tempfile

    from events_fixture import SCHEMA, T0, iso
    from sparkmart.plans import transactions as T
    from sparkmart.streaming import transactions as ST

    rows_in, off = [], 0
    for i, (user, amount, source, lag, twice) in enumerate(msgs):
        record = T0 + dt.timedelta(seconds=20 * i)                # record time only increases
        body = json.dumps({"user_id": f"U{user}", "amount": amount,
                           "timestamp": iso(record - dt.timedelta(seconds=lag)), "source": source})
        for _ in range(2 if twice else 1):
            rows_in.append((None, body, "transactions", 0, off, record))
            off += 1
    root = tempfile.mkdtemp(prefix="prop-stream-")
    size = -(-len(rows_in) // files)
    for f in range(files):
        part = rows_in[f * size:(f + 1) * size]
        if part:
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{root}/in/p{f:02d}")
    src = lambda: (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
                   .option("recursiveFileLookup", "true").parquet(f"{root}/in"))
    ST.start_split_sink(ST.validated_stream(src()), f"{root}/v", f"{root}/d", f"{root}/ck1",
                        "availableNow").awaitTermination()
    q, _ = ST.start_window_report(ST.validated_stream(src()), f"{root}/w", f"{root}/ck2",
                                  trigger="availableNow")
    q.awaitTermination()

    batch = T.validate_batch(spark.createDataFrame(rows_in, SCHEMA))
    valid, dlq = T.split(batch)
    cols = list(T.OUTPUT_COLUMNS)
    def read(p):
        return spark.read.parquet(p).select(*cols) if os.path.exists(p) else None

    got_v, got_d = read(f"{root}/v"), read(f"{root}/d")
    assert (rows(got_v) if got_v is not None else []) == rows(valid)
    assert (rows(got_d) if got_d is not None else []) == rows(dlq)
    expect_w = dict(rows(T.flat_windows(T.window_counts(valid)), "window_start", "running_total"))
    if expect_w:
        w = spark.read.parquet(f"{root}/w")
        last = w.groupBy("window_start").agg(F.max_by("running_total", "batch_id").alias("n"))
        assert dict(rows(last)) == expect_w


@SETTINGS
@given(st.lists(st.tuples(small_int, st.integers(0, 9)), max_size=15),
       st.lists(st.tuples(small_int, st.integers(0, 9), st.integers(0, 3)), max_size=15))
def test_upsert_broadcast_and_shuffled_paths_agree(spark, target, updates):
    t = spark.createDataFrame([(k, v, -1) for k, v in target], "id int, v int, seq int")
    u = spark.createDataFrame(updates, "id int, v int, seq int")
    a = upsert(t, u, ["id"], ["seq"], broadcast_keys_max=1000)
    b = upsert(t, u, ["id"], ["seq"], broadcast_keys_max=0)
    assert rows(a) == rows(b)
