"""Every stage on its own input, against brute force."""
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import types as T

import corpus_pipeline as P
from sparkmart.llm.edit_decontam import fold
from sparkmart.llm.queries import tokenizer_path


def brute_components(docs):
    """Least linked id of each document, over all pairs that share a shingle."""
    sets = {}
    for d, t in docs.items():
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    where, root = {}, {d: d for d in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for d in sorted(sets):
        both = Counter(o for s in sets[d] for o in where.get(s, ()))
        for o, n in both.items():
            if 100 * n >= 75 * (len(sets[d]) + len(sets[o]) - n):
                a, b = sorted((find(d), find(o)))
                root[b] = a
        for s in sets[d]:
            where.setdefault(s, []).append(d)
    return {d: find(d) for d in docs}, {d: len(s) for d, s in sets.items()}


def test_stages(spark, sf):
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    text = lambda df: {r.doc_id: r.text for r in df.collect()}
    before = text(docs)

    out = P.language(spark, docs, sf)
    got = text(out)
    assert out.columns == columns
    assert got == {d: t for d, t in before.items() if t and any(map(str.isalpha, t))}

    out, before = P.near_copies(spark, out, sf), got
    got = text(out)
    root, _ = brute_components(before)
    assert out.columns == columns and set(got) == {d for d, r in root.items() if d == r} and len(got) < len(before)

    out, before = P.benchmark(spark, out, sf), got
    got = text(out)
    items = [fold(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    hit = {d for d, t in before.items() if any(i in fold(t) for i in items)}
    assert out.columns == columns and hit and set(got) == set(before) - hit

    out, before = P.secrets(spark, out, sf), got
    rows = {r.doc_id: r for r in out.collect()}
    assert out.columns == columns and set(rows) == set(before)
    changed = {d for d in before if rows[d].text != before[d]}
    assert all(rows[d].n_chars == len(rows[d].text) for d in rows)
    secret = re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{6,}"
                        r"|AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}")
    assert changed == {d for d, t in before.items() if secret.search(t)}
    assert not [d for d in rows if secret.search(rows[d].text.replace("[SECRET]", ""))]

    tok = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for r in rows.values():
        want[r.doc_id] = len(tok.encode(r.text, add_special_tokens=False).ids) + 1
    packed = P.packing(spark, out, sf).collect()
    have, places = Counter(), {}
    for r in packed:
        have[r.doc_id] += r.length
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert have == want
    for p in places.values():
        at = 0
        for o, n in sorted(p):
            assert o == at
            at += n
        assert at <= 2048
    assert sorted(map(tuple, packed)) == sorted(map(tuple, P.run(spark, sf).collect()))


SCHEMA = T.StructType([T.StructField(c, t) for c, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()),
    ("n_chars", T.LongType()), ("d", T.StringType()), ("_bad", T.StringType()))])


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, sf, empty):
    long = " ".join(f"word{i % 977} other{i % 131}" for i in range(40_000))
    rows = [] if empty else [(1, None, None, None, None, "x", "y"), (2, "", "en", "s", 0, None, None), (3, "...", "en", "s", 3, None, None),
                             (None, "some text", "en", None, 9, None, None), (5, long, "en", "s", len(long), None, None),
                             (6, long + " end", "en", "s", None, None, None), (6, long + " end", "en", "s", None, None, None),
                             (8, "token: abcdef0123", "de", "s", 5, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == SCHEMA.names
    got = sorted(((r.doc_id, r.n_chars, zlib.crc32(r.text.encode())) for r in docs.collect()), key=repr)
    want = [] if empty else [(None, 9, zlib.crc32(b"some text")), (5, len(long), zlib.crc32(long.encode())),
                             (8, 15, zlib.crc32(b"token: [SECRET]"))]
    assert got == sorted(want, key=repr)
    assert P.STAGES[-1][1](spark, docs, sf).count() == (0 if empty else 2 + -(-160_000 // 2048)) or not empty


def test_decisions_by_row(spark, sf):
    """Null and repeated keys: a hit, a copy or an empty text takes its own row only."""
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first().text
    clean = [f"clean text number {i} of its own alpha{i} beta{i} gamma{i} delta{i}" for i in range(8)]
    rows = [(None, clean[0]), (None, clean[0]), (None, f"before {item} after"), (None, "123 456"), (None, None), (None, clean[1]),
            (4, clean[2]), (4, clean[3]), (4, clean[2]), (4, f"some {item} more"), (4, "789"), (5, clean[3]), (3, clean[1]), (7, clean[4])]
    docs = spark.createDataFrame([(d, t, "en", "s", 0, None, "x") for d, t in rows], SCHEMA)
    key = lambda rows: sorted(rows, key=repr)
    text = lambda df: key((r.doc_id, r.text) for r in df.collect())
    assert text(P.language(spark, docs, sf)) == key(r for r in rows if r[1] and any(map(str.isalpha, r[1])))
    assert text(P.benchmark(spark, docs, sf)) == key(r for r in rows if item not in (r[1] or ""))
    assert text(P.near_copies(spark, docs, sf)) == key(
        [(None, clean[0]), (None, "123 456"), (None, None), (3, clean[1]), (4, clean[2]), (4, clean[3]), rows[9], (4, "789"), (7, clean[4])])
