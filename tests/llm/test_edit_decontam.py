"""Decontamination against plain dynamic programming."""
import random

import pytest
from pyspark.sql import types as T

from sparkmart.llm.edit_decontam import Matcher, contaminated, fold, myers, pieces
from sparkmart.llm.queries import QUERIES


def distance(pattern, text):
    """Least edits between the pattern and any part of the text, and its first end."""
    row = list(range(len(pattern) + 1))
    best = (row[-1], 0)
    for end, c in enumerate(text, 1):
        new = [0]
        for i, p in enumerate(pattern):
            new.append(min(row[i] + (p != c), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, (row[-1], end))
    return best


@pytest.mark.parametrize("seed", range(60))
def test_myers_is_the_distance(seed):
    rng = random.Random(seed)
    p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 90)))
    t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) + p[rng.randint(0, 3):] + "ab"
    want = distance(p, t)
    budget = rng.randint(0, 8)
    assert myers(p, t, budget) == (want if want[0] <= budget and want[1] else None)


def test_pieces_cover():
    for n in (24, 25, 99, 334):
        for k in range(0, 17):
            got = pieces("x" * n, k)
            assert len(got) == k + 1 and sum(len(p) for _, p in got) == n
            assert [a for a, _ in got] == [sum(len(p) for _, p in got[:i]) for i in range(k + 1)]


def test_matcher_loses_nothing_within_the_budget():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(50)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(2, 40)))) for i in range(30)]
    match = Matcher(items, 0.05)
    for _ in range(150):
        i, t = rng.choice(items)
        t = list(t)
        for _ in range(rng.randint(0, int(0.07 * len(t)))):
            at = rng.randrange(len(t))
            t[at:at + 1] = rng.choice([[], ["z"], [t[at], "q"]])
        doc = fold(" ".join(rng.choice(words) for _ in range(30)) + " " + "".join(t) + " . " + rng.choice(words))
        got = {x[0]: x[1] for x in match(doc)}
        for j, item in items:
            if len(item) >= 24:
                d = distance(item, doc)[0]
                assert got.get(j) == (d if d <= int(0.05 * len(item)) else None)


def test_query(spark, sf):
    docs = {r.doc_id: fold(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: fold(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r.distance for r in QUERIES["op3_edit_decontam"](spark, sf).collect()}
    exact = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    assert exact and exact == {k for k, v in got.items() if v == 0}
    for (d, i), v in got.items():
        assert distance(items[i], docs[d])[0] == v <= 0.05 * len(items[i])


SCHEMA = T.StructType([T.StructField(c, t) for c, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("item_id", T.StringType()), ("distance", T.StringType()))])


def test_edges_and_blocks(spark):
    item = "An item of ordinary length, which stands in the text"
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (None, item), (4, "short one")],
                                  "item_id long, text string")
    rows = [(None, f"x\n{item.upper()}  y", None, "q"), (5, None, None, None), (6, "", None, None), (7, "ashort one", "1", None),
            (7, "a SHORT\tone.", "1", None), (8, "clean words only", None, None), (9, "é " * 5000 + item.replace("ordinary", "ordinry"), None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = [(None, 1, 0), (None, 1, 0), (7, 4, 0), (9, 1, 1), (9, 1, 1)]
    for block in (4 << 20, 20):
        got = sorted(((r.doc_id, r.item_id, r.distance) for r in contaminated(df, bench, block=block).collect()), key=repr)
        assert got == sorted(want, key=repr)
    assert contaminated(df.limit(0), bench).count() == 0 and contaminated(df, bench.limit(0)).count() == 0


def test_items_keep_their_ids(spark, tmp_path):
    """Null ids and ids that are no numbers: every item with a text is matched."""
    item = "An item of ordinary length, which stands in the text"
    bench = spark.createDataFrame([("q-1", item), (None, item), (None, ""), (None, None), ("x", "not in it at all")], "item_id string, text string")
    df = spark.createDataFrame([(1, f"x {item} y", None, None), (2, "clean", None, None)], SCHEMA)
    for block in (4 << 20, 20):
        got = contaminated(df, bench, block=block, null_items=True)
        assert sorted(((r.doc_id, r.item_id, r.distance) for r in got.collect()), key=repr) == [(1, "q-1", 0), (1, None, 0)]
    assert [(r.doc_id, r.item_id) for r in contaminated(df, bench).collect()] == [(1, "q-1")]
    df.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    bench.where("item_id IS NULL").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [(r.doc_id, r.item_id) for r in QUERIES["op3_edit_decontam"](spark, str(tmp_path)).collect()] == [(1, None)]


def test_very_long_text(spark):
    """A million characters in one row: found at its end, and at its least distance."""
    item = "An item of ordinary length, which stands in the text"
    text = "clean words only " * 60_000 + item.replace("ordinary", "ordinry") + " and " + item
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    r, = contaminated(spark.createDataFrame([(1, text, None, None)], SCHEMA), bench).collect()
    assert (r.distance, r.end) == (0, len(fold(text)))
