"""Windows of ``k`` consecutive units (words or bytes) that also start elsewhere.

Frame of the two substring-dedup operators; each brings its own index.

1. Every window has an anchor: the least hash among its grams of ``gram``
   units.  Neighbouring windows mostly share it, so a document falls into
   segments of windows with one anchor, and equal windows have equal anchors:
   only segments under the same anchor can share a window.
2. Anchors that occur once need nothing more.  Of the others, segments of
   equal content form a class; all but a class's first members are removed
   whole.  Tasks already settle the later members among their own rows, so a
   passage that a third of the documents share sends a row or so per task.
3. Where an anchor has several classes, the classes' first members are sent,
   with their content, to shards by anchor, and a shard's index tells which of
   their windows stand earlier in another.  Anchors of very many classes go
   another way, which is exact too and has no group by anchor: their windows are
   grouped one by one by their own hash, which combines before the shuffle.  Such are
   anchors of which any task sees more than ``CROWD`` classes among ``FLUSH`` segments
   (a line in a third of all documents; they are told before anything is grouped by
   anchor, so a group holds at most ``CROWD`` rows a task and ``FLUSH`` segments), and those
   with more than ``HOT_CLASSES`` classes or ``SHARD_WINDOWS`` windows.
4. The removed spans return to their documents.

Content hashes have 62 bits, modulo primes, under a 64-bit anchor.  A null key stands
before all others.  Rows that repeat a key and a text are the same document; rows that
repeat a key with another text are told apart, and ordered, by text hash.  Windows that
start in documents of one key do not count against each other.  A text is cut into
slices of ``SLICE`` units, so a very long one takes memory for its own bytes and a
slice; a shard's index holds ``SHARD_WINDOWS`` windows, twice as many at most.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import grams, mix, release, runs, sliding_min, small, span_hashes, table, tidy, word_hashes, _BYTE

#: units of a document handled at a time, and windows of a segment at most
SLICE, SEGMENT = 1 << 19, 256   # a segment's windows fit 10 bits
#: windows per shard (memory bound of an index task), classes of an anchor that go to one shard
SHARD_WINDOWS, HOT_CLASSES = 250_000, 20_000
#: classes of one anchor that a task may see among FLUSH segments, or all of its own if these are fewer
CROWD = 1024
#: document keys that are broadcast at most (16 bytes each); beyond, a shuffle join
BROADCAST_KEYS = 2_000_000

_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Unit:
    """What a window counts: ``words`` or ``bytes``; grams for anchors; and
    whether a repeat inside one document counts."""
    name: str
    k: int
    gram: int
    inside: bool

    def values(self, raw: bytes) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
        if self.name == "words":
            return word_hashes(raw)
        return np.frombuffer(raw, np.uint8), None, None

    def gram_hashes(self, values: np.ndarray) -> np.ndarray:
        if self.name == "words":
            return grams(values, self.gram)
        n = len(values) - 7
        eight = np.ndarray((n,), "<u8", values, strides=(1,))  # each 8 bytes as a number
        return mix(eight[:n - self.gram + 8] * _K1 + (eight[self.gram - 8:] ^ _K2))

    def body(self, raw: bytes, starts, ends, s: int, n: int) -> bytes:
        """Content of units s..s+n-1."""
        if self.name == "bytes":
            return raw[s:s + n]
        return b" ".join([raw[a:b] for a, b in zip(starts[s:s + n].tolist(), ends[s:s + n].tolist())])


def segments(values: np.ndarray, unit: Unit) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, content hash, start, windows, whether the anchor stands there twice) per slice."""
    w = unit.k - unit.gram + 1
    for at in range(0, max(0, len(values) - unit.k + 1), SLICE):
        part = values[at:at + SLICE + unit.k - 1]
        g = unit.gram_hashes(part)
        least = sliding_min(g, w)
        start, n = runs(least)
        if (n > SEGMENT).any():
            cut = [np.arange(a, a + c, SEGMENT) for a, c in zip(start, n)]
            start = np.concatenate(cut)
            n = np.diff(np.append(start, len(least)))
        anchor = least[start]
        twice = np.zeros(len(start), bool)
        if unit.inside:
            pad = np.zeros(w - 1, np.uint64)
            chosen = np.flatnonzero(g == ~sliding_min(~np.concatenate((pad, least, pad)), w))
            v, c = np.unique(g[chosen], return_counts=True)
            twice = c[np.searchsorted(v, anchor)] > 1
        hashed = part if unit.name == "words" else _BYTE[part]
        content = span_hashes(hashed, start, start + n + unit.k - 1)
        yield anchor.view(np.int64), content.view(np.int64), start + at, n, twice


def _source(df: DataFrame, key: str, text: str, unique: bool) -> DataFrame:
    """The rows as _key, d (key, nulls first), v (text hash; 0 where keys are unique: it
    would only widen the rows), t."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return df.select(F.col(key).alias("_key"), F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("d"),
                     (F.lit(0).cast("long") if unique else F.xxhash64(t)).alias("v"), t.alias("t"))


def keys_are_unique(df: DataFrame, key: str) -> bool:
    k = F.col(key).cast("long")
    return df.groupBy(k.alias("k")).count().where("count > 1").limit(1).count() == 0


#: rows of segments that a task gathers before it settles repeats among them
FLUSH = 500_000


def _all_segments(src: DataFrame, unit: Unit) -> DataFrame:
    """Segments as a, c, d, v and p: start * 4096 + windows * 4 + f * 2 + w, where f: the
    anchor stands there twice, w: settled (removed whole, as its content stands earlier in
    the task; its anchor is then a number of its own); and h: the anchor has a crowd of classes."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        out, rows = [], 0
        for b in batches:
            for d, v, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                raw = t.as_buffer().to_pybytes()
                if len(raw) < unit.k:
                    continue
                for part in segments(unit.values(raw)[0], unit):
                    out.append((*part, np.full(len(part[0]), d), np.full(len(part[0]), v)))
                    rows += len(part[0])
                if rows > FLUSH:
                    yield settle(out, pa)
                    out, rows = [], 0
        if out:
            yield settle(out, pa)

    def settle(out, pa):
        a, c, s, n, f, d, v = (np.concatenate(x) for x in zip(*out))
        order = np.lexsort((s, v, d, c, a))
        head = np.concatenate(([True], (a[order][1:] != a[order][:-1]) | (c[order][1:] != c[order][:-1])))
        lead = np.empty(len(a), np.int64)
        lead[order] = order[np.flatnonzero(head)[np.cumsum(head) - 1]]
        first, size = runs(a[order])
        crowd = np.empty(len(a), bool)
        crowd[order] = np.repeat(np.add.reduceat(head, first) > CROWD, size)
        w = d > d[lead]
        if unit.inside:
            w |= (d == d[lead]) & ((v > v[lead]) | (v == v[lead]) & (s > s[lead]))
        # a settled row needs no meeting place: spread it
        a = np.where(w, mix((d * 1_000_003 + s).astype(np.uint64)).view(np.int64), a)
        p = s * 4096 + n * 4 + f * 2 + w
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(np.where(w, 0, c)), pa.array(d, pa.int64()),
                                           pa.array(v, pa.int64()), pa.array(p), pa.array(crowd & ~w)], names=["a", "c", "d", "v", "p", "h"])

    return src.select("d", "v", "t").mapInArrow(tidy(run), "a long, c long, d long, v long, p long, h boolean")


def _with_keys(src: DataFrame, lists: DataFrame, how: str = "inner") -> DataFrame:
    """``src`` joined to per-document ``lists``.  While few documents are
    listed, their keys go to the scan first, so that only their texts move."""
    if lists.count() > BROADCAST_KEYS:
        return src.join(lists, ["d", "v"], how)
    keys = F.broadcast(lists.select("d", "v"))
    got = src.join(keys, ["d", "v"], "left_semi").join(lists, ["d", "v"])
    if how == "inner":
        return got
    rest = src.join(keys, ["d", "v"], "left_anti")
    return got.unionByName(rest, allowMissingColumns=True)


def _bodies(src: DataFrame, wanted: DataFrame, unit: Unit) -> DataFrame:
    """The content of the wanted segments: a, c, d, v, s, n, body."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            rows, size = [], 0
            for d, v, t, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist()):
                raw = t.as_buffer().to_pybytes()
                _, starts, ends = unit.values(raw)
                for x in w:
                    body = unit.body(raw, starts, ends, x["s"], x["n"] + unit.k - 1)
                    rows.append((x["a"], x["c"], d, v, x["s"], x["n"], body))
                    size += len(body)
                if size > 4 << 20:
                    yield pack(rows, pa)
                    rows, size = [], 0
            if rows:
                yield pack(rows, pa)

    def pack(rows, pa):
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:6]] + [pa.array(cols[6], pa.binary())],
                                          names=["a", "c", "d", "v", "s", "n", "body"])

    lists = table(wanted.groupBy("d", "v").agg(F.collect_list(F.struct("s", "n", "a", "c")).alias("w")), "wanted")
    return _with_keys(src, lists).select("d", "v", "t", "w").mapInArrow(
        tidy(run), "a long, c long, d long, v long, s long, n long, body binary")


def _hot(src: DataFrame, wanted: DataFrame, unit: Unit) -> DataFrame:
    """Exact way for anchors with very many classes: windows grouped by their own hash."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            cols = [x.to_pylist() for x in b.columns]
            for a, c, d, v, s, n, body in zip(*cols):
                vals = unit.values(body)[0]
                at = np.arange(n)
                h = span_hashes(vals if unit.name == "words" else _BYTE[vals], at, at + unit.k).view(np.int64)
                full = lambda x: pa.array(np.full(n, x), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(h), full(a), full(c), full(d), full(v), full(s), pa.array(at)],
                                                 names=["h", "a", "c", "d", "v", "s", "o"])

    win = table(_bodies(src, wanted, unit).mapInArrow(tidy(run), "h long, a long, c long, d long, v long, s long, o long"), "hot")
    # windows that stand once need no more; both sides being written, a join can split a window of a crowd
    first = win.groupBy("h", "a").agg(F.min(F.struct("d", "v", "s", "o")).alias("first"), F.count(F.lit(1)).alias("times"))
    first = table(first.where("times > 1").drop("times"), "first")
    me = F.struct("d", "v", "s", "o")
    later = (F.col("first") < me) if unit.inside else (F.col("first.d") < F.col("d"))
    got = win.join(first, ["h", "a"]).where(later)
    # neighbours become one span: as many rows as a class has runs, not windows
    run = F.col("o") - F.dense_rank().over(Window.partitionBy("a", "c").orderBy("o"))
    got = got.select("a", "c", "o", run.alias("run")).groupBy("a", "c", "run")
    return got.agg(F.min("o").alias("lo"), (F.max("o") + unit.k).alias("hi")).drop("run")


def removed_spans(df: DataFrame, unit: Unit, index: Callable, *, key: str, text: str, unique: bool,
                  shard_windows: int = SHARD_WINDOWS, hot_classes: int = HOT_CLASSES) -> DataFrame:
    """``unique``: no key stands twice.  Per document with something to remove: d, v, ``cuts`` (array of (lo, hi) in
    units, may overlap).  ``index(unit, rows)`` gets a shard's rows, a pandas frame
    with a, c, d, v, s, n, body in order of (d, v, s), and yields (row, lo, hi)."""
    src = _source(df, key, text, unique)
    found = table(_all_segments(src, unit), "segments")
    crowds = table(found.where("h").select("a").distinct(), "crowds")
    crowded = crowds.limit(1).count() > 0
    # one exchange by anchor and one sort answer all that is asked of anchors and classes
    place = F.col("d"), F.col("v"), F.col("p")
    by_class, by_anchor = Window.partitionBy("a", "c").orderBy(*place), Window.partitionBy("a")
    firsts = {"r": F.rank().over(by_class), "d0": F.first("d").over(by_class)}
    rows = (found.join(small(crowds), "a", "left_anti") if crowded else found).drop("h").repartition("a")
    rows = rows.withColumns(firsts)
    lead = F.when(F.col("r") == 1, F.shiftright("p", 2).bitwiseAND(1023))
    rows = rows.withColumns({"m": F.count(lead).over(by_anchor), "f": F.max(F.col("p").bitwiseAND(2)).over(by_anchor) > 0,
                             "hot": (F.count(lead).over(by_anchor) > hot_classes) | (F.sum(lead).over(by_anchor) > shard_windows)})
    if crowded:     # all of a crowd's classes go the other way
        more = found.join(small(crowds), "a", "left_semi").drop("h").repartition("a", "c").withColumns(firsts)
        rows = rows.unionByName(more.withColumns({"m": F.lit(2).cast("long"), "f": F.lit(True), "hot": F.lit(True)}))
    settled = F.col("p").bitwiseAND(1) == 1
    later = ((F.col("r") > 1) if unit.inside else (F.col("d") > F.col("d0"))) | settled
    # a settled row's anchor is random: should it meet another there, that one is checked in vain
    rows = rows.withColumn("whole", later).where(F.col("whole") | (F.col("m") > 1) | F.col("f"))
    name = lambda c: F.when(~F.col("whole"), F.col(c)).alias(c)
    members = table(rows.select(
        name("a"), name("c"), name("r"), "hot", "d", "v", "whole", F.shiftright("p", 12).alias("s"),
        F.shiftright("p", 2).bitwiseAND(1023).alias("n")), "members")
    leads = members.where("r = 1")
    total, heated = leads.agg(F.sum(F.when(~F.col("hot"), F.col("n"))), F.count(F.when(F.col("hot"), 1))).first()
    shards = max(1, -(-(total or 0) // shard_windows))
    hot, leads = leads.where("hot"), leads.where("NOT hot")
    cool = _bodies(src, leads, unit) \
        .withColumn("shard", F.pmod(F.xxhash64("a"), F.lit(shards)))

    def run(pdf):
        import pandas as pd
        release()                         # what the shard before has left
        pdf = pdf.drop_duplicates(["a", "c"]).sort_values(["d", "v", "s"], kind="stable", ignore_index=True)
        got = list(index(unit, pdf))
        row = np.concatenate([g[0] for g in got]) if got else np.empty(0, np.int64)
        return pd.DataFrame({"a": pdf["a"].to_numpy()[row], "c": pdf["c"].to_numpy()[row],
                             "lo": np.concatenate([g[1] for g in got]) if got else row,
                             "hi": np.concatenate([g[2] for g in got]) if got else row})

    part = cool.groupBy("shard").applyInPandas(run, "a long, c long, lo long, hi long")
    if heated:
        part = part.unionByName(_hot(src, hot, unit))
    part = part.groupBy("a", "c").agg(F.collect_list(F.struct("lo", "hi")).alias("cuts"))  # one segment's: the join makes a row a member
    moved = F.transform("cuts", lambda x: F.struct((F.col("s") + x.lo).alias("lo"), (F.col("s") + x.hi).alias("hi")))
    part = part.join(members.where(~F.col("whole")), ["a", "c"]).select("d", "v", moved.alias("cuts"))
    all_of_it = F.struct(F.col("s").alias("lo"), (F.col("s") + F.col("n") + unit.k - 1).alias("hi"))
    whole = members.where("whole").select("d", "v", F.array(all_of_it).alias("cuts"))
    cuts = whole.unionByName(part).groupBy("d", "v").agg(F.flatten(F.collect_list("cuts")).alias("cuts"))  # one document's
    return table(cuts, "cuts")


def remove_repeats(df: DataFrame, unit: Unit, index: Callable, *, key: str, text: str, **sizes) -> DataFrame:
    """``removed_spans`` and ``apply_cuts``."""
    unique = keys_are_unique(df, key)
    cuts = removed_spans(df, unit, index, key=key, text=text, unique=unique, **sizes)
    return apply_cuts(df, cuts, unit, key=key, text=text, unique=unique)


def merged(cuts: list[dict] | None) -> list[tuple[int, int]]:
    """Overlapping or touching spans joined, in order."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((c["lo"], c["hi"]) for c in cuts or ()):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def apply_cuts(df: DataFrame, cuts: DataFrame, unit: Unit, *, key: str, text: str, unique: bool) -> DataFrame:
    """A row per row of ``df``: key, ``n_units``, ``spans`` (removed, in units), ``kept`` (bytes)."""
    src = _source(df, key, text, unique)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            at, units, spans, kept, size = [], [], [], [], 0
            for i, (t, c) in enumerate(zip(b.column(1), b.column(2).to_pylist())):
                raw, cut = t.as_buffer().to_pybytes(), merged(c)
                if unit.name == "bytes":
                    n, body = len(raw), raw
                    if cut:
                        body = b"".join(raw[a:z] for a, z in zip([0, *(h for _, h in cut)], [*(lo for lo, _ in cut), n]))
                else:
                    words = raw.split()
                    n = len(words)
                    for lo, hi in reversed(cut):
                        del words[lo:hi]
                    body = b" ".join(words)
                at.append(i)
                units.append(n)
                spans.append([{"start": lo, "end": hi} for lo, hi in cut])
                kept.append(body)
                size += len(body)
                if size > 8 << 20 or i == b.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(units, pa.int64()),
                                                      pa.array(spans, span), pa.array(kept, pa.binary())],
                                                     names=[key, "n_units", "spans", "kept"])
                    at, units, spans, kept, size = [], [], [], [], 0

    return _with_keys(src, cuts, "left").select("_key", "t", "cuts").mapInArrow(
        tidy(run), f"`{key}` {kind}, n_units long, spans array<struct<start: long, end: long>>, kept binary")
