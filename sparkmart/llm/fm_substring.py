"""Substring dedup over words with a compressed FM-index per shard.

A word is removed where a window of ``k`` consecutive words covers it whose
words also start in a document with a smaller key.  ``windows`` finds what can
repeat at all and deals it to shards.  A shard's segments form one text over
the shard's words; its Burrows-Wheeler transform is kept in a wavelet matrix of
packed bits.  Segments are streamed through it from right to left: each step
prepends a word (backward search, two rank queries per bit level), and once
the match is ``k`` long it is held at ``k`` by widening to the rows that agree
on k words.  So the matching statistics, cut at ``k``, come at one step per
word, and each full-length match gives the smallest key in its interval.

Defined cases (very long texts and repeated keys: see ``windows``): of equal windows the
one in the document with the least key stays, ties within it stay too; a null or empty
text has no words; an empty
table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from sparkmart.llm.common import word_hashes
from sparkmart.llm.windows import Unit, remove_repeats


class Bits:
    """A packed bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.zeros((n >> 6) + 1, np.uint64)
        raw = np.packbits(bits, bitorder="little")
        packed.view(np.uint8)[:len(raw)] = raw
        self.words = packed
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)))

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class FMIndex:
    """FM-index of several sequences of symbols 1..sigma, with intervals of
    suffixes that agree on ``k`` symbols."""

    def __init__(self, texts: list[np.ndarray], sigma: int, k: int):
        sep = np.arange(len(texts))
        n = sum(map(len, texts)) + len(texts)
        self.ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        s = np.zeros(n, np.int64)
        keep = np.ones(n, bool)
        keep[self.ends] = False
        s[keep] = np.concatenate(texts) if texts else []
        # prefix doubling; separators differ, so all suffixes do in the end
        rank = s + len(texts) - 1
        rank[self.ends] = sep
        order, rank = self._order(rank, np.zeros(n, np.int64))
        at_k, depth = None, 1
        while rank.max(initial=0) < n - 1 or at_k is None:
            if at_k is None and 2 * depth >= k:  # names of k symbols, from two names of `depth`
                at_k = rank * (n + 1) + self._ahead(rank, k - depth)
            if rank.max(initial=0) < n - 1:
                order, rank = self._order(rank, self._ahead(rank, depth))
                depth *= 2
            elif at_k is None:
                at_k = rank
        self.sa, self.n = order, n
        last = s[order - 1]  # order 0: the final separator
        self.first = np.concatenate(([0], np.cumsum(np.bincount(s, minlength=sigma + 1))))
        self.levels = []
        for b in range(int(sigma).bit_length() - 1, -1, -1):
            bit = (last >> b & 1).astype(bool)
            self.levels.append((b, Bits(bit), n - int(bit.sum())))
            last = np.concatenate((last[~bit], last[bit]))
        base = np.zeros(sigma + 1, np.int64)
        self.base = self._walk(np.arange(sigma + 1), base)
        name = at_k[order]
        cut = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
        self.group_start = cut
        self.group = np.zeros(n, np.int64)
        self.group[cut[1:]] = 1
        self.group = np.cumsum(self.group)
        self.group_end = np.append(cut[1:], n)

    @staticmethod
    def _ahead(rank: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros(len(rank), np.int64)
        if by < len(rank):
            out[:len(rank) - by] = rank[by:] + 1
        return out

    @staticmethod
    def _order(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = high * (int(low.max(initial=0)) + 1) + low
        order = np.argsort(key, kind="stable")
        new = np.zeros(len(key), np.int64)
        new[order] = np.cumsum(np.concatenate(([0], key[order][1:] != key[order][:-1])))
        return order, new

    def _walk(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for b, bits, zeros in self.levels:
            one = bits.rank(i)
            i = np.where(symbol >> b & 1, zeros + one, i - one)
        return i

    def prepend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of symbol + match, for intervals of the match."""
        start = self.first[symbol] - self.base[symbol]
        return start + self._walk(symbol, lo), start + self._walk(symbol, hi)


def matches(index: FMIndex, streams: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stream, start, group) of every window of k symbols that occurs in the
    index.  All streams advance together.  Symbol 0 occurs nowhere."""
    size = np.array([len(s) for s in streams])
    begin = np.concatenate(([0], np.cumsum(size)))[:-1]
    flat = np.concatenate(streams) if streams else np.empty(0, np.int64)
    who = np.flatnonzero(size >= k)
    j = size[who] - 1                      # the symbol to prepend
    got = np.zeros(len(who), np.int64)     # matched so far
    lo, hi = np.zeros(len(who), np.int64), np.full(len(who), index.n)
    out = []
    while len(who):
        c = flat[begin[who] + j]
        lo2, hi2 = index.prepend(c, lo, hi)
        ok = (hi2 > lo2) & (c > 0)
        full = ok & (got + 1 >= k)
        # a miss: the match [j, end) is nowhere, so the next end is one to the left;
        # but where k symbols stood behind j, the window from j may still occur without the last
        end = np.where(got >= k, j + k, j + got)
        got = np.where(ok, np.minimum(got + 1, k), 0)
        g = index.group[np.minimum(lo2, index.n - 1)]
        if full.any():
            out.append((who[full], j[full], g[full]))
        lo = np.where(full, index.group_start[g], np.where(ok, lo2, 0))
        hi = np.where(full, index.group_end[g], np.where(ok, hi2, index.n))
        j = np.where(ok, j - 1, end - 1)
        # left of j there must be room for what a window still lacks
        on = j >= np.maximum(k - 1 - got, 0)
        who, j, got, lo, hi = who[on], j[on], got[on], lo[on], hi[on]
    if not out:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out))


def smaller_key(unit: Unit, rows):
    """Windows of a shard's segments that also start under a smaller key."""
    hashed = [word_hashes(b)[0] for b in rows["body"].tolist()]
    known, symbol = np.unique(np.concatenate(hashed), return_inverse=True)
    texts = np.split(symbol + 1, np.cumsum([len(h) for h in hashed])[:-1])
    index = FMIndex(texts, len(known), unit.k)
    key = rows["d"].to_numpy()
    owner = np.searchsorted(index.ends, index.sa, "left")
    least = np.minimum.reduceat(key[owner], index.group_start)
    row, place, group = matches(index, texts, unit.k)
    hit = least[group] < key[row]
    row, place = row[hit], place[hit]
    order = np.lexsort((place, row))
    row, place = row[order], place[order]
    if len(row):
        head = np.concatenate(([True], (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)))
        tail = np.append(head[1:], True)
        yield row[head], place[head], place[tail] + unit.k


def dedup_words(df: DataFrame, k: int = 50, *, key: str = "doc_id", text: str = "text", **sizes) -> DataFrame:
    """A row per row of ``df``: key, ``n_units`` (words), ``spans`` (maximal
    removed runs, in words) and ``kept`` (the remaining words, one space between)."""
    return remove_repeats(df, Unit("words", k, min(6, k), False), smaller_key, key=key, text=text, **sizes)
