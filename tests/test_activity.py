import json
import random
import tempfile

from pyspark.sql import functions as F

from conftest import rows
from sparkmart.plans import activity as A
from sparkmart.streaming import activity as SA

SCHEMA = "key string, value string, topic string, partition int, offset long, timestamp timestamp"


def test_key_partition_matches_the_producer_assignment(spark):
    df = spark.createDataFrame([("user_1",), ("user_2",), ("user_3",)], "key string")
    assert rows(A.assign_partitions(df, "key", 3)) == [("user_1", 2), ("user_2", 2), ("user_3", 1)]


def _messages(n, seed=3):
    rnd = random.Random(seed)
    out = []
    for off in range(n):
        key = "hot" if rnd.random() < 0.4 else f"user_{rnd.randrange(5)}"
        part = 0 if key == "hot" else rnd.randrange(3)
        out.append((key, json.dumps({"timestamp": 1_700_000_000 + off, "action": "click",
                                     "amount": rnd.randrange(100, 500)}),
                    "events_topic", part, off, None))
    return out


def test_running_count_blockwise_equals_brute_force(spark):
    msgs = _messages(300)
    ev = A.parse_activity(spark.createDataFrame(msgs, SCHEMA))
    got = rows(A.key_running_count(ev, block_size=7), "key", "partition", "offset", "running_count")
    seen, expect = {}, []
    for key, _, _, part, off, _ in sorted(msgs, key=lambda m: (m[3], m[4])):
        seen[key] = seen.get(key, 0) + 1
        expect.append((key, part, off, seen[key]))
    assert got == sorted(expect)


def test_running_count_peers_share_the_count(spark):
    from sparkmart.operators.running import running_count
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 5)], "k string, o int")
    got = rows(running_count(df, ["k"], ["o"], [F.floor(F.col("o") / 10)]), "k", "o", "running_count")
    assert got == [("a", 1, 2), ("a", 1, 2), ("a", 2, 3), ("b", 5, 1)]


def test_key_counts_and_stream_restart(spark):
    root = tempfile.mkdtemp(prefix="keys-")
    msgs = _messages(60)
    for i in range(3):
        spark.createDataFrame(msgs[i * 20:(i + 1) * 20], SCHEMA).coalesce(1) \
            .write.parquet(f"{root}/in/p{i}")
    src = lambda: (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
                   .option("recursiveFileLookup", "true").parquet(f"{root}/in"))
    SA.start_key_counts(src(), f"{root}/out", f"{root}/ck", "availableNow").awaitTermination()
    expect = {}
    for m in msgs:
        expect[m[0]] = expect.get(m[0], 0) + 1
    assert dict(rows(SA.read_key_counts(spark, f"{root}/out"))) == expect
    batch = dict(rows(A.key_event_counts(A.parse_activity(spark.createDataFrame(msgs, SCHEMA)))))
    assert batch == expect
    extra = _messages(10, seed=9)
    spark.createDataFrame(extra, SCHEMA).coalesce(1).write.parquet(f"{root}/in/p9")
    SA.start_key_counts(src(), f"{root}/out", f"{root}/ck", "availableNow").awaitTermination()
    for m in extra:
        expect[m[0]] = expect.get(m[0], 0) + 1
    assert dict(rows(SA.read_key_counts(spark, f"{root}/out"))) == expect


def test_keyed_json(spark):
    df = spark.createDataFrame([("user_1", 5, "login")], "k string, amount int, action string")
    r = A.keyed_json(df, "k", ["action", "amount"]).first()
    assert r["key"] == "user_1" and json.loads(r["value"]) == {"action": "login", "amount": 5}


def test_order_like_log(spark):
    df = spark.createDataFrame([(f"user_{i % 5}", i) for i in range(200)], "key string, offset long")
    out = A.order_like_log(df, 3)
    per_task = out.rdd.glom().collect()
    seen = {}
    for t, part in enumerate(per_task):
        offsets = {}
        for r in part:
            assert seen.setdefault(r["key"], t) == t          # a key lives in one task
            assert offsets.get(r["key"], -1) < r["offset"]     # in offset order
            offsets[r["key"]] = r["offset"]
    assert sum(len(p) for p in per_task) == 200


def test_key_counts_complete_mode_writes_the_full_map(spark):
    root = tempfile.mkdtemp(prefix="keys-")
    msgs = _messages(30)
    for i in range(2):
        spark.createDataFrame(msgs[i * 15:(i + 1) * 15], SCHEMA).coalesce(1).write.parquet(f"{root}/in/p{i}")
    src = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
           .option("recursiveFileLookup", "true").parquet(f"{root}/in"))
    SA.start_key_counts(src, f"{root}/out", f"{root}/ck", "availableNow", mode="complete").awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    last = out.filter(F.col("batch_id") == out.agg(F.max("batch_id")).first()[0])
    expect = {}
    for m in msgs:
        expect[m[0]] = expect.get(m[0], 0) + 1
    assert dict(rows(last.select("key", "event_count"))) == expect
