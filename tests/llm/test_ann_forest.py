"""Nearest neighbours: exact scores, recall against brute force, edges."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.llm.ann_forest import BITS, Forest, search, wanted
from sparkmart.llm.queries import QUERIES


def brute(ids, x, asks, k=10):
    out = {}
    for i, q in zip(ids, x):
        if asks(i):
            d = np.sqrt(((x - q) ** 2).sum(1))
            out[i] = sorted((float(s), int(j)) for s, j in zip(d, ids) if j != i)[:k]
    return out


@pytest.mark.parametrize("size", ["0.001", "0.1"])
def test_recall(spark, size):
    sf = f"/root/testdata/sf{size}"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    want = brute(ids, x, lambda i: i % 100 == 0)
    got = {}
    for r in QUERIES["op1_hash_forest"](spark, sf).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    at, hit, total = {i: n for n, i in enumerate(ids)}, 0, 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11))
        assert [(s, v) for _, v, s in found] == sorted((s, v) for _, v, s in found)
        for _, v, s in found:
            assert math.isclose(s, np.sqrt(((x[at[v]] - x[at[q]]) ** 2).sum()), rel_tol=1e-12, abs_tol=1e-15)
        hit += len({v for _, v, _ in found} & {v for _, v in want[q]})
        total += 10
    assert hit >= 0.9 * total


def test_synchronous_ascent_stops_at_the_longest_prefixes():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 24))
    f = Forest(x)
    q = x[:5]
    for i, found in enumerate(f.candidates(q, 400)):
        # brute force: the longest common prefix in any tree, ascending until enough are held
        best = np.full(len(x), -1)
        for turn, planes in f.trees:
            keys = f.hash(x, turn, planes)
            mine = f.hash(q[i:i + 1], turn, planes)[0]
            lcp = np.array([f.symbol_bits + BITS - int(int(k) ^ int(mine)).bit_length() for k in keys])
            best = np.maximum(best, np.where(lcp >= f.symbol_bits, lcp, 0))
        chosen = next(lev for lev in range(best.max(), -1, -1) if (best >= lev).sum() >= 400)
        assert i in found and len(found) >= 400
        assert set(found) == set(np.flatnonzero(best >= chosen))


SCHEMA = T.StructType([T.StructField(c, t) for c, t in (
    ("vec_id", T.LongType()), ("embedding", T.ArrayType(T.FloatType())), ("h", T.StringType()), ("c", T.StringType()))])


def test_edges_and_hot_copies(spark):
    a, b, c = [1.0, 0.0], [0.0, 1.0], [0.0, -2.0]
    rows = [(i, a, None, "x") for i in range(0, 300)] + [(400, b, None, None), (500, c, None, None), (500, c, None, None)]
    rows += [(600, None, None, None), (700, [0.0, 0.0], None, None), (800, [float("nan"), 1.0], None, None),
             (900, [None, 1.0], None, None), (1000, [], None, None), (1100, [1.0], None, None), (None, a, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in search(df, F.col("vec_id") % 100 == 0, 10, shard=2).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute(np.array([*range(300), 400, 500]), np.array([a] * 300 + [b, c]), lambda i: i % 100 == 0)
    assert set(got) == set(want)
    for q, found in got.items():
        assert [(s, v) for _, v, s in sorted(found)] == want[q]
    few = df.where("vec_id >= 299")
    assert sorted((r.query_id, r.rank, r.vec_id) for r in search(few, F.col("vec_id") % 100 == 0).collect()) == [
        (400, 1, 299), (400, 2, 500), (500, 1, 299), (500, 2, 400)]
    assert search(df.limit(0), F.lit(True)).count() == 0
    assert wanted(0) == 0 and wanted(5) == 5


def shapes(seed):
    rng = np.random.default_rng(seed)
    n = 4000
    yield "centred", rng.normal(size=(n, 64))
    yield "shifted", rng.normal(size=(n, 64)) + 5
    yield "norms", (rng.normal(size=(n, 64)) + 2) * np.exp(rng.normal(size=(n, 1)) / 2)
    yield "clustered", rng.normal(size=(60, 64))[rng.integers(0, 60, n)] * 3 + rng.normal(size=(n, 64))
    low = rng.normal(size=(n, 12)) @ rng.normal(size=(12, 256))
    yield "256 components", low + rng.normal(size=(n, 256)) * .1
    yield "768 components", rng.normal(size=(n // 4, 10)) @ rng.normal(size=(10, 768)) + 1


@pytest.mark.parametrize("name,x", list(shapes(1)), ids=lambda v: v if isinstance(v, str) else "")
def test_recall_on_shapes(name, x):
    """Recall of queries that did not settle the number of candidates, and the share measured."""
    from sparkmart.llm.ann_forest import SAMPLE, enough, _nearest_of
    q = x[:SAMPLE + 60]
    ascents = list(Forest(x).ascents(q))
    least = enough(x, q[:SAMPLE], ascents[:SAMPLE], 11)
    hit, share = 0, 0.0
    for row, ascent in zip(q[SAMPLE:], ascents[SAMPLE:]):
        found = ascent(least)
        want = np.sort(np.sqrt(((x - row) ** 2).sum(1)))[10]
        hit += int((_nearest_of(x, row, found, 11)[1] <= want).sum())
        share += len(found) / len(x) / 60
    print(name, hit / 660, share)
    assert hit >= 0.9 * 660
    assert share < {"clustered": .1, "256 components": .35, "768 components": .5}.get(name, 1)
