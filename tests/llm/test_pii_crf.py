"""Personal data: patterns against plain regular expressions, message passing against
enumeration, held-out documents, edges."""
import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import types as T

from sparkmart.llm import pii_crf as P
from sparkmart.llm.queries import QUERIES

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute(text):
    """The contract's patterns as they stand, and its conditions."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def named(spans):
    return [f"{P.KINDS[k]}:{a}:{z}" for k, a, z in spans]


def test_patterns_on_odd_texts():
    rng = random.Random(1)
    parts = ["@", ".", "a", "mail", "-", "+", "1", "25", "255", "256", "0001", " ", "  ", "(", ")", "4539578763621486", "4465 7583 8288 9437",
             "x@y.z", "10.0.0.1", "+1 (743) 555-3824", "é", "_", "%", "\n", "79927398713", ".5.6.7.8"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        assert named(P.base_spans(text)) == brute(text), text


def test_patterns_take_linear_time():
    t0 = time.perf_counter()
    for text in ("a" * 10 ** 6, "1" * 10 ** 6, "a@" * 300_000, "+1" + " " * 10 ** 6, "1." * 400_000, "@" * 10 ** 6, "1 " * 300_000 + "x"):
        P.base_spans(text)
    assert time.perf_counter() - t0 < 20


@pytest.mark.parametrize("seed", range(4))
def test_messages_on_a_tree(seed):
    """A chain of three, one of two, and a tie between them: no loop, so exact."""
    rng = np.random.default_rng(seed)
    unary = rng.normal(size=(5, 4)) * 2
    edges = [(np.array([0, 1, 3]), np.array([1, 2, 4]), rng.normal(size=(4, 4))),
             (np.array([1]), np.array([3]), rng.normal(size=(4, 4))), (np.array([], int), np.array([], int), np.zeros((4, 4)))]
    want, pair = np.zeros((5, 4)), np.zeros((4, 4))
    for y in itertools.product(range(4), repeat=5):
        w = np.exp(sum(unary[i, a] for i, a in enumerate(y)) + sum(p[y[a], y[b]] for e in edges for a, b, p in [(a, b, e[2]) for a, b in zip(*e[:2])]))
        want[range(5), y] += w
        pair[y[1], y[3]] += w
    node, pairs = P.beliefs(unary, edges, rounds=60)
    assert np.allclose(node, want / want.sum(1, keepdims=True), atol=1e-3)
    assert np.allclose(pairs[1], pair / pair.sum(), atol=1e-3)


@pytest.fixture(scope="module")
def model(spark):
    return P.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_held_out_practice(model):
    docs = P.practice(400, "thing other words mail so la que der".split(), 77)
    right = wrong = lost = 0
    for (text, meant), (base, more) in zip(docs, P.detect([d for d, _ in docs], model)):
        spans = [s[:3] for s in base + more]
        hit = [any(k == s[0] and s[1] < z and a < s[2] for s in spans) for k, a, z in meant]
        right, lost = right + sum(hit), lost + len(hit) - sum(hit)
        wrong += sum(not any(k == s[0] and s[1] < z and a < s[2] for s in meant) for k, a, z, _ in more)
    assert right > 500 and lost < 0.1 * right and wrong < 0.02 * right


def test_repeats_share_a_label(model):
    """A masked card and a card with a wrong digit count beside the card itself only."""
    card, odd = "4539578763621486", ["4539578763721486", "****1486"]
    alone, together = P.detect([f"so {odd[0]} and other {odd[1]} words", f"so {card} and {odd[0]} or, far off, {odd[1]} words"], model)
    assert not alone[1] and [s[0] for s in together[1]] == [2, 2]
    blind = P.Model(model.weights, model.begin, model.move, np.zeros((2, 2)))
    assert not P.detect([f"so {card} and {odd[0]} or, far off, {odd[1]} words"], blind)[0][1]


def test_many_repeats_have_as_many_ties(model):
    g = P.Graph()
    g.add(0, "call 5553824 " * 3000)
    assert len(g.doc) == 3000 and len(g.skip) == 2999 and not g.chain


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op11_pii_crf"](spark, sf).collect()}
    assert len(got) == len(docs)
    for d in docs:
        want, r = brute(d.text), got[d.doc_id]
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(w.startswith(k) for w in want) for k in PATTERNS]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(want) <= set(spans) and (spans or not want)
        place = [(list(PATTERNS).index(k), int(a), int(z)) for k, a, z in (s.split(":") for s in spans)]
        assert place == sorted(place) and all(0 <= a < z <= len(d.text) for _, a, z in place)
        if not re.search("[0-9@]", d.text or ""):
            assert not spans


def test_edges(spark, model):
    assert P.find(spark.createDataFrame([], SCHEMA)).collect() == []
    long = "word " * 200_000 + "a.b@mail.example.com " + "7 " * 20_000
    rows = [(1, None), (2, ""), (None, "é a.b@mail.example.com"), (None, "é a.b@mail.example.com"), (3, long), (4, "no digits here"), (5, "@"), (6, "9" * 50_000)]
    extra = T.StructType([*SCHEMA, *(T.StructField(n, T.StringType()) for n in ("base", "spans", "Key", "t", "h"))])
    df = spark.createDataFrame([(*r, *"abcde") for r in rows], extra)
    got = [(r.doc_id, r.base, [s.text for s in r.spans]) for r in P.find(df, model).collect()]
    assert sorted(got, key=repr) == sorted([(1, [], []), (2, [], []), (4, [], []), (5, [], []), (6, [], []),
                                            *[(None, ["email:2:22"], ["a.b@mail.example.com"])] * 2,
                                            (3, ["email:1000000:1000020"], ["a.b@mail.example.com"])], key=repr)
    assert P.find(df.limit(2)).count() == 2      # nothing to learn from but the practice
