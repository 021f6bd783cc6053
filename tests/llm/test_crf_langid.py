"""Language ID: forward-backward against enumeration, held-out accuracy, edges."""
import itertools

import numpy as np
import pytest
from pyspark.sql import types as T

from sparkmart.llm import crf_langid
from sparkmart.llm.crf_langid import all_features, features, fit, forward_backward, identify, label_words
from sparkmart.llm.queries import QUERIES


@pytest.mark.parametrize("seed", range(4))
def test_forward_backward_is_the_sum_over_paths(seed):
    rng = np.random.default_rng(seed)
    sizes, labels = [1, 4, 2, 3], int(rng.integers(1, 4))
    score, move = rng.normal(size=(sum(sizes), labels)), rng.normal(size=(labels, labels))
    begin = np.cumsum(sizes) - sizes
    p, pairs = forward_backward(score, begin, np.array(sizes), move, pairs=True)
    want, want_pairs = np.zeros_like(score), np.zeros_like(move)
    for b, n in zip(begin, sizes):
        paths = list(itertools.product(range(labels), repeat=n))
        w = np.exp([sum(score[b + i, y] for i, y in enumerate(q)) + sum(move[a, c] for a, c in zip(q, q[1:])) for q in paths])
        for q, x in zip(paths, w / w.sum()):
            for i, y in enumerate(q):
                want[b + i, y] += x
            for a, c in zip(q, q[1:]):
                want_pairs[a, c] += x
    assert np.allclose(p, want) and np.allclose(pairs, want_pairs)


@pytest.mark.parametrize("seed", range(3))
def test_features_of_many_words_are_those_of_each(monkeypatch, seed):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcé日𝒳²"), rng.integers(1, 12))) for _ in range(400)] + ["a", "é", "日", "𝒳"]
    lexicon = frozenset(words[::3])
    flat, n = all_features(words, lexicon)
    assert [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])] == [features(w, lexicon) for w in words]
    weights = rng.normal(size=(crf_langid.BUCKETS, 3)).astype(np.float32)
    model = crf_langid.Model(["x", "y", "z"], weights, np.zeros((3, 3)), lexicon)
    monkeypatch.setattr(crf_langid, "SCORED", 7)                         # block by block
    np.testing.assert_allclose(model.scores(words), [weights[features(w, lexicon)].sum(0) for w in words], rtol=1e-4, atol=1e-4)
    assert model.scores([]).shape == (0, 3)


def test_held_out_accuracy(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = QUERIES["op9_crf_langid"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    held = [r for r in got if r.held_out]
    assert 100 < len(held) < 300
    assert sum(docs[r.doc_id].lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


SCHEMA = T.StructType([T.StructField(c, t) for c, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("score", T.StringType()))])
EN = "the house and the garden with the river that they were thinking of"
DE = "das haus und der garten mit dem fluss den sie sich gedacht haben"


def test_code_switched_text_and_edges(spark):
    model = fit([("en", " ".join(np.random.default_rng(i).permutation(EN.split()))) for i in range(30)]
                + [("de", " ".join(np.random.default_rng(i).permutation(DE.split()))) for i in range(30)])
    rows = [(1, f"{EN} {EN}. {DE}", "x", None), (2, None, None, None), (3, "", "en", None), (4, "123 ²½ --", "en", None),
            (None, DE, None, "1"), (None, DE, None, "1"), (6, EN * 400, "en", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = label_words(df, model).collect()
    one = next(r for r in got if r.doc_id == 1)
    assert (one.lang, one.words) == ("en", 39) and 0.5 < one.score < 0.8
    assert [(p.lang, p.first) for p in one.parts] == [("en", 0), ("de", 26)]
    assert {(r.lang, r.score, r.words) for r in got if r.doc_id in (2, 3, 4)} == {("und", 0.0, 0)}
    assert [r.lang for r in got if r.doc_id is None] == ["de", "de"]
    assert next(r for r in got if r.doc_id == 6).lang == "en"
    assert label_words(df.limit(0), model).count() == 0
    unlabelled = df.withColumn("lang", df["lang"].substr(9, 1)).where("doc_id = 2")
    assert [r.lang for r in identify(df, unlabelled).collect()] == ["und"] * len(rows)


def test_sample_takes_whole_texts(spark):
    """Repeated rows count once, short texts come first, a label of long texts only is still learned."""
    from sparkmart.llm.crf_langid import LONGEST, sample
    long = " ".join(DE.split() * 60)
    assert len(long) > LONGEST
    rows = [(i, EN + f" {chr(97 + i % 26)}x", "en", None) for i in range(50)] + [(5, EN, "en", None)] * 200
    rows += [(100, EN + " " + long, "en", None), (101, long, "de", None), (102, long + " so", "de", None)]
    got = sample(spark.createDataFrame(rows, SCHEMA), key="doc_id", text="text", label="lang", per_label=51)
    assert sorted(t for lab, t in got if lab == "de") == sorted([long, long + " so"])
    assert len([t for lab, t in got if lab == "en"]) == 51 and all(len(t) <= LONGEST for lab, t in got if lab == "en")
    assert sample(spark.createDataFrame([], SCHEMA), key="doc_id", text="text", label="lang") == []
