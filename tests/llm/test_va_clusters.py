"""VA-file clustering: a plain loop over all vectors, bounds, edges."""
import hashlib

import numpy as np
import pytest
from pyspark.sql import types as T

from sparkmart.llm.queries import QUERIES
from sparkmart.llm.va_clusters import cells, cluster, left, lookup, nearest, packed, summary, unpacked

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.StringType())])


def brute(rows, size=64, k=8, rounds=10):
    """Python integers and a loop, from the contract's words."""
    kept = []
    for key, v, *_ in rows:
        if v is not None and len(v) == size and all(x is not None and np.isfinite(x) and abs(x) < 2 ** 17 for x in v):
            kept.append((key, [int(np.floor(1024 * float(np.float32(x)))) for x in v]))
    first = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    if not first:
        return []
    c = [v for _, v in first]
    x = np.array([v for _, v in kept], np.int64)

    def assign():
        d = ((x[:, None] - np.array(c, np.int64)[None]) ** 2).sum(2)
        return d.argmin(1), d.min(1)

    for _ in range(rounds):
        at, _ = assign()
        c = [[int(s) // int((at == i).sum()) for s in x[at == i].sum(0)] if (at == i).any() else c[i] for i in range(len(c))]
    at, d = assign()
    name = [hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in c]
    return sorted(((key, int(i), int(e), int(d[at == i].sum()), int(d.sum()), name[i]) for (key, _), i, e in zip(kept, at, d)), key=repr)


def got(df):
    cols = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows)
    assert len(want) > 400 and got(QUERIES["op12_va_clusters"](spark, sf)) == want


@pytest.mark.parametrize("bits", [1, 4, 8])
def test_shapes(spark, bits):
    """Clustered, shifted and repeated vectors, one far away, whatever the cells."""
    rng = np.random.default_rng(bits)
    x = np.concatenate((rng.normal(size=(5, 64))[rng.integers(0, 5, 200)] * 3 + rng.normal(size=(200, 64)),
                        rng.normal(size=(80, 64)) * .01 + 40, np.repeat(rng.normal(size=(1, 64)), 60, 0), np.full((1, 64), -90_000.0)))
    rows = [(i, [float(np.float32(a)) for a in v], None) for i, v in enumerate(x)]
    assert got(summary(*cluster(spark.createDataFrame(rows, SCHEMA), bits=bits))) == brute(rows)


def test_intervals_hold_and_cells_are_kept():
    rng = np.random.default_rng(3)
    x = rng.integers(-500, 500, (300, 7))
    edges = np.sort(np.concatenate((np.full((7, 1), -500), rng.integers(-400, 400, (7, 31)), np.full((7, 1), 500)), 1), 1)
    c = rng.integers(-300, 300, (5, 7))
    cell = cells(x, edges)
    assert (np.take_along_axis(edges, cell.T.astype(int), 1).T <= x).all() and (x < np.take_along_axis(edges, cell.T + 1, 1).T).all()
    assert (unpacked(packed(cell, 5), 5, 7) == cell).all()
    may, best = left(cell, lookup(c, edges)), nearest(x, c)
    assert may[np.arange(300), best].all() and 0 < (may.sum(1) == 1).sum()


def test_edges(spark):
    bad = [(1, None, "a"), (2, [], "a"), (3, [1.0] * 63, "a"), (4, [1.0] * 63 + [None], "a"), (5, [float("nan")] * 64, "a"),
           (6, [float("inf")] + [0.0] * 63, "a"), (7, [3e38] + [0.0] * 63, "a")]
    assert cluster(spark.createDataFrame([], SCHEMA))[0].collect() == [] == got(summary(*cluster(spark.createDataFrame(bad, SCHEMA))))
    v = [[float(i % 7)] * 64 for i in range(9)]
    rows = bad + [(10, v[1], "x"), (10, v[1], "x"), (10, v[2], "y"), (None, v[3], None), (None, v[3], None), (11, [0.0] * 64, "z")]
    schema = T.StructType([*SCHEMA, *(T.StructField(n, T.IntegerType()) for n in ("r", "k", "v", "cluster", "CELLS", "was", "c"))])
    df = spark.createDataFrame([(*r, *range(7)) for r in rows], schema)
    want = brute(rows)
    assert got(summary(*cluster(df))) == want and [r[0] for r in want].count(None) == 2
    none = [(None, v[3], "x")]
    assert got(summary(*cluster(spark.createDataFrame(none, SCHEMA)))) == brute(none) == []
