"""Bucketed upserts, bucketed joins, CSV with broken lines, the range sweep."""
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sparkmart.operators.range_join import range_left_join
from sparkmart.operators.range_sweep import covering, range_summary
from sparkmart.operators.upsert import upsert
from sparkmart.plans import batch_fact, models
from sparkmart.sinks import tables
from sparkmart.sinks.buckets import BUCKET, BucketedTable
from sparkmart.sinks.tables import write_bucketed
from sparkmart.sources.files import csv_headers, read_csv_checked


@pytest.fixture()
def root():
    return tempfile.mkdtemp(prefix="storage-")


def files(root):
    """Every data file with its time of change."""
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{root}/data") for f in names if f.endswith(".parquet")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- upserts by bucket

SCHEMA = "id long, v string, at long"


def test_upsert_rewrites_touched_buckets_only(spark, root):
    t = BucketedTable(spark, root, ["id"], 16)
    first = spark.createDataFrame([(i, f"v{i}", 0) for i in range(300)] + [(None, "n", 0)], SCHEMA)
    t.create(first, "1")
    assert rows(t.read()) == rows(first)
    before = files(root)
    updates = spark.createDataFrame([(7, "a", 1), (7, "b", 2), (1000, "new", 1), (8, None, 1)], SCHEMA)
    touched = t.upsert(updates, ["at"], "2")
    after = files(root)
    assert 1 <= len(touched) <= 3 and all(after[f] == before[f] for f in before)          # untouched files stay as they are
    assert {f.split(f"{BUCKET}=")[1].split("/")[0] for f in set(after) - set(before)} == {str(b) for b in touched}
    assert t.versions() == {b: "2" if b in touched else "1" for b in range(16)}
    assert rows(t.read()) == rows(upsert(first, updates, ["id"], ["at"]))
    assert t.upsert(updates.limit(0), ["at"], "3") == [] and set(t.versions().values()) == {"1", "2"}
    with pytest.raises(ValueError, match="committed already"):
        t.upsert(updates, ["at"], "2")


def test_scan_of_an_upsert_is_pruned(spark, root):
    t = BucketedTable(spark, root, ["id"], 8)
    t.create(spark.range(200).select("id", F.lit("x").alias("v"), F.lit(0).cast("long").alias("at")), "1")
    part = t.read([3])
    assert "PartitionFilters: [" in plan(part) and f"{BUCKET}" in plan(part).split("PartitionFilters: [")[1].split("]")[0]
    scanned = {os.path.basename(os.path.dirname(f)) for f in part.inputFiles()}
    assert part.count() == t.read().where(F.pmod(F.xxhash64("id"), F.lit(8)) == 3).count() > 0
    assert {f"{BUCKET}=3"} <= scanned


def test_upserts_over_commits(spark, root):
    rng = random.Random(4)
    t, want = BucketedTable(spark, root, ["id"], 4), {}
    for version in range(1, 5):
        batch = [(rng.randrange(40), f"{version}.{i}", version * 100 + i) for i in range(30)]
        for k, v, at in batch:
            want[k] = (k, v, at)
        df = spark.createDataFrame(batch, SCHEMA)
        if version == 1:
            latest = {r[0]: r for r in batch}
            t.create(spark.createDataFrame(list(latest.values()), SCHEMA), "1")
        else:
            t.upsert(df, ["at"], str(version))
    assert rows(t.read()) == sorted(want.values())


def test_an_attempt_without_commit_shows_nothing(spark, root):
    t = BucketedTable(spark, root, ["id"], 4)
    t.create(spark.createDataFrame([(1, "a", 0)], SCHEMA), "1")
    t._write(spark.createDataFrame([(1, "half", 1), (2, "half", 1)], SCHEMA), "2")       # no manifest follows
    assert rows(t.read()) == [(1, "a", 0)]
    t.upsert(spark.createDataFrame([(1, "b", 1)], SCHEMA), ["at"], "2")
    assert rows(t.read()) == [(1, "b", 1)]
    empty = BucketedTable(spark, f"{root}/empty", ["id"], 4)
    empty.create(spark.createDataFrame([], SCHEMA), "1")
    assert empty.read().count() == 0 and empty.read().columns == ["id", "v", "at"]
    empty.upsert(spark.createDataFrame([(1, "b", 1)], SCHEMA), ["at"], "2")
    assert rows(empty.read()) == [(1, "b", 1)]


# ---- bucketed tables

def test_bucketed_joins_need_no_exchange(spark, root):
    orders = spark.createDataFrame([(i, i % 7, None) for i in range(500)], "order_id long, customer_id long, order_date date")
    items = spark.createDataFrame([(i % 450, i, 2, 1.5) for i in range(900)], "order_id long, product_id long, quantity int, price double")
    stored = [write_bucketed(df, f"test_{n}", ["order_id"], 4, f"{root}/{n}") for n, df in (("orders", orders), ("items", items))]
    fact = batch_fact.build_fact(*stored)
    assert rows(fact) == rows(batch_fact.build_fact(orders, items))
    assert "Exchange" not in plan(fact) and "SortMergeJoin" in plan(fact)
    assert "Exchange" in plan(batch_fact.build_fact(orders, items))
    pay = spark.createDataFrame([(i, i % 50, float(i)) for i in range(300)], "payment_id long, customer_id long, amount double")
    who = spark.createDataFrame([(i, f"f{i}", "l") for i in range(60)], "customer_id long, first_name string, last_name string")
    stored = [write_bucketed(df, f"test_{n}", ["customer_id"], 4, f"{root}/{n}") for n, df in (("pay", pay), ("who", who))]
    base = models.int_customer_payment(*stored)
    assert rows(base) == rows(models.int_customer_payment(pay, who))
    assert "Exchange" not in plan(base)


def test_buckets_grow_with_the_tables(spark, monkeypatch):
    import __spark_entry__ as E
    monkeypatch.setattr(tables, "BUCKET_BYTES", 1 << 10)
    orders = spark.createDataFrame([(i, i % 7, None) for i in range(500)], "order_id long, customer_id long, order_date date")
    items = spark.createDataFrame([(i % 450, i, 2, 1.5) for i in range(900)], "order_id long, product_id long, quantity int, price double")
    assert tables.bucket_count(orders, items, least=8) == -(-900 * 40 // 1024)      # of the larger one
    assert tables.bucket_count(orders.limit(3), items.limit(0), least=8) == 8
    stored = E._stored(spark, "order_id", orders=orders, items=items)
    assert all(len(t.inputFiles()) > 8 for t in stored)
    fact = batch_fact.build_fact(*stored)
    assert rows(fact) == rows(batch_fact.build_fact(orders, items)) and "Exchange" not in plan(fact)


# ---- CSV

def write(root, name, *lines):
    os.makedirs(root, exist_ok=True)
    with open(f"{root}/{name}", "w", newline="") as f:
        f.write("\n".join(lines) + "\n")


def test_headers_in_any_order_and_broken_lines(spark, root):
    write(root, "a.csv", "id,name,qty", "1,x,2", '2,"y, z",3', "3,too,many,cells", "4,few", '5,"open,6', "", '6,"a ""b""",1')
    write(root, "b.csv", "qty,id,other,name", "9,7,o,n", "1,2,3", "8,8,,")
    write(root, "c.csv", "name", "only")
    write(root, "d.csv", "id,name,qty")
    assert {h: len(f) for h, f in csv_headers(spark, root).items()} == {
        ("id", "name", "qty"): 2, ("qty", "id", "other", "name"): 1, ("name",): 1}
    good, bad = read_csv_checked(spark, root, ["id", "name", "qty"])
    assert rows(good) == [(None, "only", None), ("1", "x", "2"), ("2", "y, z", "3"), ("6", 'a "b"', "1"), ("7", "n", "9"), ("8", None, "8")]
    assert rows(bad) == [("1,2,3",), ("3,too,many,cells",), ("4,few",), ('5,"open,6',)]
    # one column only: the lines are still judged by all their cells
    assert rows(read_csv_checked(spark, root, ["qty"])[1]) == rows(bad)


def test_csv_edges(spark, root):
    write(f"{root}/twice", "a.csv", "id,id", "1,2")
    with pytest.raises(ValueError, match="stands twice"):
        read_csv_checked(spark, f"{root}/twice", ["id"])
    os.makedirs(f"{root}/none")
    open(f"{root}/none/a.csv", "w").close()
    good, bad = read_csv_checked(spark, f"{root}/none", ["id", "v"])
    assert good.columns == ["id", "v"] and good.count() == bad.count() == 0


# ---- range sweep

def brute(values, bands):
    out = {}
    for v in {v for v in values if v is not None}:
        hit = [i for lo, hi, i in bands if lo is not None and hi is not None and lo <= v <= hi]
        out[v] = (len(hit), min(hit, default=None))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_sweep_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    n = [0, 1, 40, 400][seed]
    values = [rng.choice([None, rng.randrange(60) / 2, rng.randrange(10 ** 6) / 8]) for _ in range(n)]
    bands = []
    for i in range(150):
        lo = rng.choice([None, rng.randrange(60) / 2, rng.randrange(10 ** 6) / 8, -10.0])
        width = rng.choice([None, 0, 1, -3, 10 ** 7, rng.randrange(1000)])
        bands.append((lo, None if lo is None or width is None else lo + width, i))
    bands += [(0.0, 10.0 ** 6, 1000 + i) for i in range(100)]       # many of the same ends
    left = spark.createDataFrame([(v,) for v in values], "v double")
    right = spark.createDataFrame(bands, "lo double, hi double, band long")
    got = {r.v: (r.bands, r.first_band) for r in range_summary(left, "v", right, "lo", "hi", "band").collect()}
    assert got == brute(values, bands)
    none = range_summary(left, "v", right.limit(0), "lo", "hi", "band").collect()
    assert {r.v: (r.bands, r.first_band) for r in none} == {v: (0, None) for v in got}


def test_sweep_agrees_with_the_hits(spark):
    left = spark.range(0, 500).select((F.col("id") / 4).cast("decimal(12,2)").alias("v"))
    right = spark.range(0, 80).select((F.col("id") * 2).cast("decimal(12,2)").alias("lo"),
                                      (F.col("id") * 2 + F.when(F.col("id") % 9 == 0, 1000).otherwise(1)).cast("decimal(12,2)").alias("hi"),
                                      F.col("id").alias("band"))
    hits = range_left_join(left, "v", right, "lo", "hi").groupBy("v").agg(F.count("band").alias("bands"), F.min("band").alias("first_band"))
    assert rows(range_summary(left, "v", right, "lo", "hi", "band")) == rows(hits)


def test_wide_bands_are_few_nodes(spark):
    """A band over all ranks is cut into at most two nodes a level."""
    n = 1 << 14
    ranges = spark.range(0, 300).select((F.col("id") % 3).alias("a"), (F.lit(n) - F.col("id") % 5).alias("z"), "id")
    got = dict(map(tuple, covering(ranges, n).collect()))
    want = {r: min(i for i in range(15) if i % 3 <= r < n - i % 5) for r in range(n)}
    assert got == want
