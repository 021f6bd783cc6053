"""Nearest neighbours by a forest of hash prefixes.

Every tree gives a vector a long hash string: a cross-polytope symbol (the
signed axis of a random rotation that lies nearest, about the shard's mean) and
then one bit per random hyperplane.  A tree's index is the sorted array of these
strings.  A query descends in each tree to its longest-prefix match and then all
trees ascend together, one prefix length at a time, until they hold enough
candidates; all of them are measured exactly, in double precision.  Above a
single symbol the ascent takes in the query's next symbols, twice as many each
time, and the root at last.

Vectors are dealt to shards of about ``SHARD`` rows, each with its own forest,
and queries visit the shards in blocks; a shard returns each query's nearest, and
these are merged.  Equal vectors form a class: the index holds classes, and a
class answers with its least ids.  Every vector is indexed.  How many candidates
are enough is settled in each shard: its first ``SAMPLE`` queries are also
answered by measuring the shard whole, and the ascent goes on until ``RECALL`` of
these answers is held.  So vectors with structure need few, and vectors without
any many; there is no other limit on candidates, and a prefix that many vectors
share is searched whole.

Defined cases: vectors that are null, zero, of another length than most, or that
hold null or non-finite components take no part; null ids take no part; rows that
repeat an id and a vector count once, an id with several vectors counts with each; ties
go to the smaller id; with fewer candidates than asked for, all are returned; an
empty table gives an empty result; other columns are not read.  There are no texts.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import table

TREES, BITS, SHARD, QUERY_BLOCK = 64, 40, 16_384, 8_192
#: candidates that the ascent is first tried with in a shard of n vectors: SHARE * n ** POWER
SHARE, POWER = 10.0, 0.65
#: queries of a shard that settle the number of candidates, and the recall asked for on them
SAMPLE, RECALL = 40, 0.96


def wanted(n: int) -> int:
    return int(min(n, np.ceil(SHARE * n ** POWER)))


class Forest:
    """Sorted arrays of hash strings over the rows of a matrix."""

    def __init__(self, x: np.ndarray, seed: int = 17):
        self.x, self.dim = x, x.shape[1]
        self.centre = x.mean(0) if len(x) else np.zeros(self.dim)
        rng = np.random.default_rng(seed)
        self.symbol_bits = int(2 * self.dim - 1).bit_length()
        self.depths = [self.symbol_bits + i for i in range(BITS + 1)]
        #: numbers of symbols that the levels above one symbol take in
        self.wider = [1 << j for j in range(self.dim.bit_length() - 1, 0, -1)]
        self.trees, self.order, self.keys, self.symbols = [], [], [], []
        for _ in range(TREES):
            turn = np.linalg.qr(rng.normal(size=(self.dim, self.dim)))[0]
            planes = rng.normal(size=(self.dim, BITS))
            self.trees.append((turn, planes))
            key = self.hash(x, turn, planes)
            order = np.argsort(key, kind="stable")
            self.order.append(order)
            self.keys.append(key[order])
            # where each symbol's run begins and ends
            self.symbols.append(np.searchsorted(self.keys[-1], np.arange(2 * self.dim + 1, dtype=np.uint64) << np.uint64(BITS)))

    def hash(self, x: np.ndarray, turn: np.ndarray, planes: np.ndarray) -> np.ndarray:
        x = x - self.centre
        y = x @ turn
        axis = np.abs(y).argmax(1)
        key = (2 * axis + (y[np.arange(len(y)), axis] > 0)).astype(np.uint64)
        for bit in ((x @ planes) > 0).T:
            key = key << np.uint64(1) | bit
        return key

    def candidates(self, q: np.ndarray, least: int):
        """Per row of ``q`` the candidates' rows."""
        for ascent in self.ascents(q):
            yield ascent(least)

    def ascents(self, q: np.ndarray):
        """Per row of ``q`` a function of the least number of candidates."""
        w = len(self.wider)
        levels = 1 + w + len(self.depths)
        lo, hi = (np.zeros((levels, TREES, len(q)), np.int64) for _ in "ab")
        hi[0] = len(self.x)   # the root: no prefix
        held = np.zeros((levels, len(q)), np.int64)
        near = np.empty((TREES, len(q), max(self.wider, default=0)), np.int64)     # next symbols, the nearest first
        for t, (turn, planes) in enumerate(self.trees):
            key = self.hash(q, turn, planes)
            for level, depth in enumerate(self.depths, 1 + w):
                drop = np.uint64(self.symbol_bits + BITS - depth)
                start = key >> drop << drop
                lo[level, t] = np.searchsorted(self.keys[t], start)
                hi[level, t] = np.searchsorted(self.keys[t], start | ((np.uint64(1) << drop) - np.uint64(1)), "right")
            if w:
                y = (q - self.centre) @ turn
                axis = np.argsort(-np.abs(y), 1, kind="stable")[:, :near.shape[2]]
                near[t] = 2 * axis + (np.take_along_axis(y, axis, 1) > 0)
                runs = np.cumsum((self.symbols[t][1:] - self.symbols[t][:-1])[near[t]], 1)
                for level, n in enumerate(self.wider, 1):
                    held[level] += runs[:, n - 1]
        single = np.r_[0, 1 + w:levels]
        held[single] = (hi - lo)[single].sum(1)

        def ascent(i):
            def found(least):
                level = int(np.flatnonzero(held[:, i] >= least)[-1]) if held[0, i] else 0   # the ascent stops here
                seen = np.zeros(len(self.x), bool)
                while True:
                    for t in range(TREES):
                        if 1 <= level <= w:
                            for s in near[t, i, :self.wider[level - 1]]:
                                seen[self.order[t][self.symbols[t][s]:self.symbols[t][s + 1]]] = True
                        else:
                            seen[self.order[t][lo[level, t, i]:hi[level, t, i]]] = True
                    got = np.flatnonzero(seen)
                    if level == 0 or len(got) >= least:
                        return got
                    level -= 1     # the trees held the same vectors: ascend further
            return found

        for i in range(len(q)):
            yield ascent(i)


def _nearest_of(x: np.ndarray, q: np.ndarray, found: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the rows ``found`` of ``x`` the k nearest to ``q``, with all that tie with the last."""
    d = np.sqrt(((x[found] - q) ** 2).sum(1))
    if len(d) > k:
        keep = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
        found, d = found[keep], d[keep]
    return found, d


def enough(x: np.ndarray, q: np.ndarray, ascents: list, k: int, recall: float = RECALL) -> int:
    """The least number of candidates, ``wanted`` times a power of two, that holds ``recall`` of
    the true answers of the queries ``q``."""
    n, everything = len(x), np.arange(len(x))
    true = [_nearest_of(x, row, everything, k)[1] for row in q]
    least = max(k, wanted(n) // 64)
    while least < n:
        hit = total = 0
        for row, ascent, want in zip(q, ascents, true):
            d = _nearest_of(x, row, ascent(least), k)[1]
            hit += min(len(d), len(want)) and int((np.sort(d)[:k] <= np.sort(want)[:k].max()).sum())
            total += min(k, len(want))
        if hit >= recall * total:
            return least
        least *= 2
    return n


def nearest(x: np.ndarray, q: np.ndarray, k: int):
    """Per row of ``q``: (rows of ``x``, Euclidean distances) of the k nearest found."""
    ascents = list(Forest(x).ascents(q))
    least = enough(x, q[:SAMPLE], ascents[:SAMPLE], k)
    for row, ascent in zip(q, ascents):
        yield _nearest_of(x, row, ascent(least), k)


def usable(vector: str) -> Column:
    """Not null or empty, all components finite, not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def search(df: DataFrame, queries: Column, k: int = 10, *, key: str = "vec_id", vector: str = "embedding",
           shard: int = SHARD) -> DataFrame:
    """The ``k`` nearest other rows of every row for which ``queries`` holds:
    query_id, rank (from 1), key, score (distance)."""
    rows = df.where(F.col(key).isNotNull() & usable(vector)).select(
        F.col(key).cast("long").alias("id"), F.coalesce(queries, F.lit(False)).alias("asks"),
        F.transform(F.col(vector), lambda x: x.cast("double") + F.lit(0.0)).alias("v"))  # -0.0 becomes 0.0
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if size is None:
        rows = rows.limit(0)
        size = (1, 0)
    rows = rows.where(F.size("v") == size[0])
    # classes of equal vectors, named by their least id and first components; 1 + k ids answer for a class
    packed = table(rows.select("id", "asks", "v", F.xxhash64("v").alias("h")), "vectors")
    classes = packed.groupBy("h", "v").agg(F.min("id").alias("c"), F.max("asks").alias("asks"))
    classes = table(classes, "classes")
    w = Window.partitionBy("h", "v").orderBy("id")
    ids = packed.select("h", "v", "id").distinct().withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k + 1)
    ids = ids.join(classes.select("h", "v", "c"), ["h", "v"]).select("c", "h", "id")
    n = classes.count()
    shards = max(1, -(-n // shard))
    asked = classes.where("asks").select("c", "h", "v")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    # whole numbers of shards and blocks: each query goes to each shard once
    points = classes.select("c", "h", "v", F.pmod(F.xxhash64("h", F.lit(1)), F.lit(shards)).cast("int").alias("shard"),
                            F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    visits = asked.select("c", "h", "v", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                          F.pmod(F.xxhash64("h"), F.lit(blocks)).cast("int").alias("block"))

    def run(left, right):
        import pandas as pd
        out = {"qc": [], "qh": [], "c": [], "h": [], "score": []}
        if len(left) and len(right):
            x, q = np.stack(left["v"].to_numpy()), np.stack(right["v"].to_numpy())
            c, h = left["c"].to_numpy(), left["h"].to_numpy()
            for i, (found, d) in enumerate(nearest(x, q, k + 1)):
                out["qc"].append(np.full(len(found), right["c"].iloc[i]))
                out["qh"].append(np.full(len(found), right["h"].iloc[i]))
                out["c"].append(c[found])
                out["h"].append(h[found])
                out["score"].append(d)
        return pd.DataFrame({n: np.concatenate(v) if v else np.empty(0, "f8" if n == "score" else "i8") for n, v in out.items()})

    got = points.groupBy("shard", "block").cogroup(visits.groupBy("shard", "block")).applyInPandas(
        run, "qc long, qh long, c long, h long, score double")
    # the nearest k + 1 rows of each asking class: its classes' ids, merged over the shards
    best = Window.partitionBy("qc", "qh").orderBy("score", "id")
    got = got.join(ids, ["c", "h"]).withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1)
    who = packed.where("asks").join(classes.select("h", "v", "c"), ["h", "v"]) \
        .select(F.col("id").alias("query_id"), F.col("c").alias("qc"), F.col("h").alias("qh")).distinct()
    rank = F.row_number().over(Window.partitionBy("query_id", "qh").orderBy("score", "id"))
    return who.join(got, ["qc", "qh"]).where(F.col("query_id") != F.col("id")).withColumn("rank", rank) \
        .where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")
