"""Centroid clustering over a VA-file (vector approximation file).

Vectors are integers here: each component x counts as floor(1024 * x).  The
VA-file holds, beside a row number, a cell of ``BITS`` bits for each component;
a component's cells are cut at its quantiles.  For a centroid, a lookup table
has for each component and cell the least and the greatest squared difference
to a value in that cell, so a row's cells give an interval for its distance to
each centroid by table lookups.

The first round reads all vectors anyway, to write the cells and to add up the
clusters.  Every later round scans the VA-file: a row whose intervals leave one
centroid is settled, and full vectors are fetched, by row number, only of rows
in which intervals overlap and of rows that change their cluster; sums and
counts change by these alone.  So results are exact, and what is fetched shrinks
as clusters settle.  The last assignment is asked for every row's distance and
so reads all vectors; the cells settle the cluster there too.  All numbers are
integers.

The driver sees cell borders, centroids, and sums (components x cells or
clusters) only.  Rounds write the rows' clusters beside their cells, so a lost
executor costs a part of one round.  Row numbers are unique, so nothing is
grouped by a key that could be hot.

Defined cases: vectors that are null, of another number of components, or with
a null or non-finite component take no part, nor do those with a component of
2**17 or more in size, whose distances a long cannot hold; a null key may be
clustered, but starts no centroid; rows of one key are vectors of their own, and
where they start centroids, the lesser vector comes first; ties go to the
smaller cluster; with fewer keys than clusters there are as many centroids as
keys, and without any, no rows; an empty table gives an empty result; other
columns are not read.  There are no texts.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import small, table, tidy

#: bits of a cell, rows that a task looks up at a time, and integers per unit of a component
BITS, ROWS, SCALE = 6, 4096, 1024
#: components are below this size as integers: 64 squared differences fit a long
MOST = 1 << 27


def cells(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The cell number of each component; cell i of component j is edges[j, i] <= x < edges[j, i + 1]."""
    out = np.empty(x.shape, np.uint8)
    for j, e in enumerate(edges):
        out[:, j] = np.searchsorted(e[1:-1], x[:, j], "right")
    return out


def packed(c: np.ndarray, bits: int) -> np.ndarray:
    """Rows of cell numbers in ``bits`` bits each."""
    return np.packbits(np.unpackbits(c[:, :, None], axis=2)[:, :, 8 - bits:].reshape(len(c), -1), axis=1)


def unpacked(raw: np.ndarray, bits: int, size: int) -> np.ndarray:
    b = np.unpackbits(raw, axis=1)[:, :size * bits].reshape(len(raw), size, bits)
    return np.packbits(np.concatenate((np.zeros((*b.shape[:2], 8 - bits), np.uint8), b), 2), axis=2)[:, :, 0]


def lookup(centroids: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Component x cell x (least squared difference to each centroid, then greatest)."""
    a = edges[:, :-1, None] - centroids.T[:, None, :]
    z = edges[:, 1:, None] - 1 - centroids.T[:, None, :]
    least = np.where((a <= 0) & (z >= 0), 0, np.minimum(a * a, z * z))
    return np.concatenate((least, np.maximum(a * a, z * z)), 2)


def left(c: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Row x centroid: whether the row's cells leave it as a nearest one."""
    bound = np.zeros((len(c), tables.shape[2]), np.int64)
    for j in range(c.shape[1]):
        bound += tables[j, c[:, j]]
    k = tables.shape[2] // 2
    return bound[:, :k] <= bound[:, k:].min(1)[:, None]


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Number of each row's nearest centroid, ties to the smaller."""
    d = np.empty((len(x), len(centroids)), np.int64)
    for i, c in enumerate(centroids):
        d[:, i] = ((x - c) ** 2).sum(1)
    return d.argmin(1)


def _matrix(column, size: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, size)


def _integers(df: DataFrame, key: str, vector: str, size: int) -> DataFrame:
    """(r, k, v): row number, key and integer components of the rows that take part."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < MOST // SCALE)
    rows = df.select(F.col(key).alias("k"), F.col(vector).alias("e")).where((F.size("e") == size) & F.forall("e", fine))
    return rows.select(F.monotonically_increasing_id().alias("r"), "k",
                       F.transform("e", lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("v"))


def _edges(rows: DataFrame, bits: int) -> np.ndarray:
    """Each component's cell borders: least, quantiles, greatest + 1."""
    cut = [i / (1 << bits) for i in range(1, 1 << bits)]
    got = rows.select(F.posexplode("v").alias("j", "x")).groupBy("j").agg(
        F.min("x").alias("lo"), F.max("x").alias("hi"), F.percentile_approx("x", cut, 1000).alias("q"))
    return np.array([[r["lo"], *r["q"], r["hi"] + 1] for r in got.orderBy("j").collect()], np.int64)


class _Change:
    """What moving rows change in the clusters' sums and counts, as a batch of k rows in
    columns (c, sum, n) after nulls."""
    SCHEMA = "c int, sum array<decimal(38,0)>, n long"

    def __init__(self, k: int, size: int):
        self.total, self.count = np.zeros((k, size), object), np.zeros(k, np.int64)

    def __call__(self, x: np.ndarray, was: np.ndarray, now: np.ndarray) -> None:
        for i in range(len(self.count)):
            for rows, sign in ((now == i) & (was != i), 1), ((was == i) & (now != i), -1):
                if rows.any():
                    self.total[i] += sign * x[rows].sum(0)
                    self.count[i] += sign * int(rows.sum())

    def columns(self) -> list:
        import pyarrow as pa
        sums = [[Decimal(int(x)) for x in t] for t in self.total]
        return [pa.array(range(len(sums)), pa.int32()), pa.array(sums, pa.list_(pa.decimal128(38))), pa.array(self.count)]

    @staticmethod
    def none(n: int) -> list:
        import pyarrow as pa
        return [pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.decimal128(38))), pa.nulls(n, pa.int64())]


def _approximated(rows: DataFrame, centroids: np.ndarray, edges: np.ndarray, bits: int) -> DataFrame:
    """(r, cells, was) with the clusters of the first round; and rows of ``_Change``."""
    k, size = centroids.shape

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        names, change = ["r", "cells", "was", "c", "sum", "n"], _Change(k, size)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                x = _matrix(b.column(1), size)
                now = nearest(x, centroids)
                change(x, np.full(len(x), -1), now)
                raw = packed(cells(x, edges), bits)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.tobytes() for c in raw], pa.binary()),
                                                  pa.array(now, pa.int32()), *_Change.none(len(x))], names=names)
        yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int32()),
                                          *change.columns()], names=names)

    return rows.select("r", "v").mapInArrow(tidy(run), "r long, cells binary, was int, " + _Change.SCHEMA)


def _looked_up(va: DataFrame, centroids: np.ndarray, edges: np.ndarray, bits: int) -> DataFrame:
    """(r, cells, was, now): the cluster that the cells leave; null where several are left."""
    tables, size = lookup(centroids, edges), centroids.shape[1]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                raw = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(b.num_rows, -1)
                may = left(unpacked(raw, bits, size), tables)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2),
                                                  pa.array(may.argmax(1).astype(np.int32), mask=may.sum(1) > 1)],
                                                 names=["r", "cells", "was", "now"])

    return va.select("r", "cells", "was").mapInArrow(tidy(run), "r long, cells binary, was int, now int")


def _fetched(seen: DataFrame, vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(r, new): exact clusters of the rows that their cells left open; and rows of
    ``_Change`` for all that move."""
    k, size = centroids.shape

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        names, change = ["r", "new", "c", "sum", "n"], _Change(k, size)
        for b in batches:
            x = _matrix(b.column(3), size)
            now = nearest(x, centroids)         # of a settled row the same as its cells say
            change(x, b.column(1).to_numpy(), now)
            open_ = b.column(2).is_null()
            yield pa.RecordBatch.from_arrays([b.column(0).filter(open_), pa.array(now, pa.int32()).filter(open_),
                                              *_Change.none(open_.true_count)], names=names)
        yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), *change.columns()], names=names)

    wanted = seen.where("now IS NULL OR now <> was").select("r", "was", "now")
    got = vectors.select("r", "v").join(small(wanted), "r").select("r", "was", "now", "v")
    return got.mapInArrow(tidy(run), "r long, new int, " + _Change.SCHEMA)


def _start(rows: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """The vectors with the least hashes of their keys."""
    place = F.sha2(F.concat(F.lit(seed), F.col("k").cast("string")), 256)
    first = rows.where(F.col("k").isNotNull()).select(place.alias("h"), "v").orderBy("h", "v").limit(clusters)
    return np.array([r["v"] for r in first.collect()], np.int64)


def cluster(df: DataFrame, *, key: str = "vec_id", vector: str = "embedding", size: int = 64, clusters: int = 8,
            rounds: int = 10, seed: str = "3:", bits: int = BITS) -> tuple[DataFrame, np.ndarray]:
    """(key, ``cluster``, ``distance``) of each row, and the final centroids.  ``seed``: what
    stands before a key where it is hashed."""
    rows, kind = table(_integers(df, key, vector, size), "vectors"), df.schema[key].dataType.simpleString()
    centroids = _start(rows, clusters, seed)
    schema = f"`{key}` {kind}, cluster int, distance long"
    if not len(centroids):
        return df.sparkSession.createDataFrame([], schema), centroids
    edges = _edges(rows, bits)
    total, count = np.zeros(centroids.shape, object), np.zeros(len(centroids), np.int64)
    va = None
    for i in range(rounds):
        if va is None:
            changed = va = table(_approximated(rows, centroids, edges, bits), "cells")
            va = va.where("r IS NOT NULL").select("r", "cells", "was")
        else:
            seen = table(_looked_up(va, centroids, edges, bits), "clusters")
            changed = table(_fetched(seen, rows, centroids), "fetched")
            exact = changed.where("r IS NOT NULL").select("r", "new")
            va = seen.join(small(exact), "r", "left").select("r", "cells", F.coalesce("new", "now").alias("was"))
        change = changed.where("c IS NOT NULL").select("c", "n", F.posexplode("sum").alias("j", "s")) \
            .groupBy("c", "j").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        for r in change.collect():                       # clusters x components
            total[r["c"], r["j"]] += int(r["s"])
            if r["j"] == 0:
                count[r["c"]] += r["n"]
        for c in np.flatnonzero(count):
            centroids[c] = [s // int(count[c]) for s in total[c]]
    tables = lookup(centroids, edges)

    def measure(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                x = _matrix(b.column(1), size)
                may = left(cells(x, edges), tables)
                now, open_ = may.argmax(1), may.sum(1) > 1
                if open_.any():
                    now[open_] = nearest(x[open_], centroids)
                d = ((x - centroids[now]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(now, pa.int32()), pa.array(d)], names=[key, "cluster", "distance"])

    return rows.select("k", "v").mapInArrow(tidy(measure), schema), centroids


def summary(clustered: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``clustered`` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256``."""
    done = table(clustered, "clustered")
    per = {r[0]: int(r[1]) for r in done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}   # clusters
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    pick = lambda values, kind: F.element_at(F.array(*map(F.lit, values)).cast(f"array<{kind}>"), F.col("cluster") + 1)
    return done.withColumns({"cluster_inertia": pick([per.get(i, 0) for i in range(len(name))], "long"),
                             "inertia": F.lit(sum(per.values())).cast("long"), "centroid_sha256": pick(name, "string")})
