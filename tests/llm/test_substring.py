"""Both substring dedup operators against brute force."""
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from sparkmart.llm import windows
from sparkmart.llm.fm_substring import FMIndex, dedup_words, matches
from sparkmart.llm.queries import QUERIES
from sparkmart.llm.suffix_levels import Levels, dedup_bytes


def brute_words(docs, k):
    """docs: [(id, text)] -> [(words, removed flags)]; null ids first."""
    split = [(d, (t or "").encode().split()) for d, t in docs]
    low = -(1 << 63)
    least = {}
    for d, w in split:
        for i in range(len(w) - k + 1):
            g = tuple(w[i:i + k])
            least[g] = min(least.get(g, 1 << 63), low if d is None else d)
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if least[tuple(w[i:i + k])] < (low if d is None else d):
                gone[i:i + k] = [True] * k
        out.append((w, gone))
    return out


def brute_bytes(docs, k):
    """docs in order of (id, ...); rows that repeat id and text count once."""
    seen, out, done = set(), [], {}
    for d, t in docs:
        raw = (t or "").encode()
        if (d, raw) not in done:
            gone = bytearray(len(raw))
            for i in range(len(raw) - k + 1):
                g = raw[i:i + k]
                if g in seen:
                    gone[i:i + k] = b"\x01" * k
                seen.add(g)
            done[d, raw] = gone
        out.append((raw, done[d, raw]))
    return out


def digest_words(w, gone):
    return hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()


def test_word_query(spark, sf):
    rows = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in QUERIES["op4_fm_substring"](spark, sf).collect()}
    assert len(got) == len(rows)
    for (d, _), (w, gone) in zip(rows, brute_words(rows, 50)):
        assert (got[d].n_words, got[d].n_removed, got[d].kept_sha256) == (len(w), sum(gone), digest_words(w, gone)), d
    assert sum(r.n_removed for r in got.values()) > 0


def test_byte_query(spark, sf):
    rows = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in QUERIES["op10_suffix_levels"](spark, sf).collect()}
    for (d, _), (raw, gone) in zip(rows, brute_bytes(rows, 100)):
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        n = sum(g and not p for g, p in zip(gone, b"\0" + gone))
        assert (got[d].n_bytes, got[d].n_removed, got[d].n_spans, got[d].kept_sha256) == (
            len(raw), sum(gone), n, hashlib.sha256(kept).hexdigest()), d


SCHEMA = T.StructType([T.StructField(c, t) for c, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("a", T.StringType()), ("d", T.StringType()))])


def fixture(seed, words):
    rng = random.Random(seed)
    parts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 30))) for _ in range(12)]
    docs = []
    for i in range(60):
        t = " ".join(rng.choice(parts) if rng.random() < 0.8 else rng.choice(words) for _ in range(rng.randint(0, 9)))
        docs.append((i, t.replace(" ", rng.choice([" ", "  ", "\n"]))))
    docs += [(60, None), (61, ""), (62, "aaaa" * 60), (63, "x" + "aaaa" * 50), (64, "é" * 80), (65, "ab " * 90)]
    return docs


@pytest.mark.parametrize("seed,hot,crowd", [(1, 20_000, 1024), (2, 1, 1024), (3, 3, 1024), (1, 20_000, 1), (4, 20_000, 3)])
def test_fixtures(spark, monkeypatch, seed, hot, crowd):
    monkeypatch.setattr(windows, "CROWD", crowd)
    words = ["a", "b", "cc", "É", "the"] if seed < 3 else [f"w{i}" for i in range(40)]
    docs = fixture(seed, words)
    df = spark.createDataFrame([(*r, None, None) for r in docs], SCHEMA)
    got = {r.doc_id: r for r in dedup_words(df, 9, shard_windows=500, hot_classes=hot).collect()}
    for (d, _), (w, gone) in zip(docs, brute_words(docs, 9)):
        assert (got[d].n_units, bytes(got[d].kept)) == (len(w), b" ".join(x for x, g in zip(w, gone) if not g)), d
    got = {r.doc_id: r for r in dedup_bytes(df, 20, shard_windows=500, hot_classes=hot).collect()}
    for (d, _), (raw, gone) in zip(docs, brute_bytes(docs, 20)):
        assert bytes(got[d].kept) == bytes(b for b, g in zip(raw, gone) if not g), d
        assert sum(s.end - s.start for s in got[d].spans) == sum(gone)


@pytest.mark.parametrize("dedup,k", [(dedup_words, 9), (dedup_bytes, 40)])
def test_a_crowds_neighbouring_windows_are_one_row(spark, monkeypatch, dedup, k):
    monkeypatch.setattr(windows, "CROWD", 1)
    seen, hot = [], windows._hot
    monkeypatch.setattr(windows, "_hot", lambda *a: seen.append(hot(*a)) or seen[-1])
    rng = random.Random(6)
    line = " ".join(f"c{i}" for i in range(40))
    docs = [(i, f"{rng.random()} {rng.random()} {line} {rng.random()}") for i in range(30)]
    docs.append((3, docs[3][1]))                                          # a key and a text that stand twice
    df = spark.createDataFrame([(*r, None, None) for r in docs], SCHEMA)
    got = [(r.doc_id, bytes(r.kept)) for r in dedup(df, k).collect()]
    if dedup is dedup_words:
        want = [(d, b" ".join(x for x, g in zip(w, gone) if not g)) for (d, _), (w, gone) in zip(docs, brute_words(docs, k))]
    else:
        want = [(d, bytes(b for b, g in zip(raw, gone) if not g)) for (d, _), (raw, gone) in zip(docs, brute_bytes(docs, k))]
    assert sorted(got) == sorted(want)
    spans = {}
    for a, c, lo, hi in seen[0].collect():
        spans.setdefault((a, c), []).append((lo, hi - k))
    assert spans and all(z + 1 < y for s in spans.values() for (_, z), (y, _) in zip(sorted(s), sorted(s)[1:]))


def test_null_and_repeated_rows(spark):
    t = " ".join(f"w{i}" for i in range(30))
    docs = [(None, t), (None, t), (4, t), (4, t), (5, "z " + t), (5, None)]
    df = spark.createDataFrame([(*r, "x", None) for r in docs], SCHEMA)
    got = sorted(((r.doc_id is not None, r.doc_id, r.n_units, bytes(r.kept)) for r in dedup_words(df, 9).collect()), key=repr)
    want = sorted(((d is not None, d, len(w), b" ".join(x for x, g in zip(w, gone) if not g))
                   for (d, _), (w, gone) in zip(docs, brute_words(docs, 9))), key=repr)
    assert got == want
    got = sorted(bytes(r.kept) for r in dedup_bytes(df, 20).collect())
    assert got == sorted([t.encode(), t.encode(), b"", b"", b"z ", b""])
    assert dedup_words(df.limit(0), 9).count() == 0 and dedup_bytes(df.limit(0), 20).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_index_streams_any_text(seed):
    rng = np.random.default_rng(seed)
    k, sigma = int(rng.integers(2, 7)), int(rng.integers(1, 6))
    texts = [rng.integers(1, sigma + 1, rng.integers(1, 40)) for _ in range(rng.integers(1, 6))]
    streams = [rng.integers(0, sigma + 1, rng.integers(0, 50)) for _ in range(8)]
    row, at, group = matches(FMIndex(texts, sigma, k), streams, k)
    there = {tuple(t[i:i + k]) for t in texts for i in range(len(t) - k + 1)}
    want = {(r, i) for r, s in enumerate(streams) for i in range(len(s) - k + 1) if tuple(s[i:i + k]) in there}
    assert set(zip(row.tolist(), at.tolist())) == want and len(row) == len(want)
    name = {}
    for r, i, g in zip(row, at, group):  # one interval per content
        assert name.setdefault(tuple(streams[r][i:i + k]), g) == g
    assert len(set(name.values())) == len(name)


def test_levels_grow_geometrically():
    family, n = Levels(), 0
    for b in range(64):
        family.add(np.sort(np.array([f"{b:03d}{i:02d}" for i in range(50)], "S5")))
        n += 50
    assert sum(map(len, family.levels)) == n and len(family.levels) <= 8
    assert family.holds(np.array([b"00000", b"06349", b"06350"], "S5")).tolist() == [True, True, False]


def test_texts_built_to_collide(spark):
    """Two Thue-Morse words have one hash under every polynomial modulo 2**64."""
    one = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    two = one.translate(str.maketrans("ab", "ba"))
    words = " ".join(f"w{i}" for i in range(30))
    docs = [(1, f"{words} {one} {words}"), (2, f"{words} {two} {words}")]
    df = spark.createDataFrame([(*r, None, None) for r in docs], SCHEMA)
    assert [bytes(r.kept).decode() for r in dedup_words(df, 50).orderBy("doc_id").collect()] == [t for _, t in docs]
    got = {r.doc_id: bytes(r.kept) for r in dedup_bytes(df, 100).collect()}
    for (d, _), (raw, gone) in zip(docs, brute_bytes(docs, 100)):
        assert got[d] == bytes(b for b, g in zip(raw, gone) if not g)
