"""Packing: ids against the plain tokenizer, steps against best-fit decreasing."""
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from sparkmart.llm.best_fit import ChunkEncoder, best_fit_steps, pack, token_pieces
from sparkmart.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


TEXTS = ["", " ", "The cat's hat, isn't it? I'd say WE'LL go.", "Été, l'ÉÇOLE ßtraße ΑΣ ΟΔΟΣ İstanbul",
         "a b c\x85d\x1ce", "x<|endoftext|>y <|ENDOFTEXT|> <|startoftext|>", "1234 5.5 ½ Ⅷ été ﬁn",
         "--- ... ,, word,. Word., ÷×ª º", "日本語 한국어 𝔘𝔫𝔦 👍🏽 zwj‍x‌", "tab\tnew\nline\r\x0b\x0cend", "z" * 300]


def test_ids_equal_the_tokenizer(tok):
    enc = ChunkEncoder(tokenizer_path())
    assert enc.fast
    rng = random.Random(3)
    alphabet = "aZéÉßÿ.,'s t́ \n0٣<|>Σσ"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(800)]
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    for arr in (pa.array(texts), pa.array(["x y", *texts, None]).slice(1, len(texts))):
        ids, ends = enc(arr)
        for t, w, lo, hi in zip(texts, want, [0, *ends[:-1]], ends):
            assert ids[lo:hi].tolist() == w, repr(t)


def best_fit_decreasing(sizes, cap):
    gaps = []
    for s in sorted(sizes, reverse=True):
        fit = [g for g in gaps if g >= s]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - s)
        else:
            gaps.append(cap - s)
    return len(gaps)


@pytest.mark.parametrize("seed", range(8))
def test_steps_equal_best_fit_decreasing(seed):
    rng = random.Random(seed)
    cap = rng.choice([10, 37, 100])
    sizes = [rng.randint(1, cap) for _ in range(rng.randint(0, 400))]
    counts = {s: sizes.count(s) for s in set(sizes)}
    used, seen = {}, {s: [] for s in counts}
    for r in best_fit_steps(counts, cap):
        for rank in range(r["lo"], r["hi"]):
            j = rank - r["lo"]
            used.setdefault(r["base"] + j // r["each"], []).append((r["place"] + j % r["each"] * r["length"], r["length"]))
            seen[r["length"]].append(rank)
    assert all(sorted(v) == list(range(counts[s])) for s, v in seen.items())
    for places in used.values():
        at = 0
        for p, n in sorted(places):
            assert p == at
            at += n
        assert at <= cap
    assert len(used) == best_fit_decreasing(sizes, cap)


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("length", T.StringType()), T.StructField("_gi", T.StringType())])


def test_edges(spark, tok):
    rows = [(1, None, "x", None), (2, "", None, "y"), (None, "hello world", None, None), (3, "a b " * 40, None, None),
            (3, "a b " * 40, None, None), (4, "one two three", None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = pack(token_pieces(df, tokenizer_path(), 16), 16).collect()
    texts = sorted((t or "") for _, t, _, _ in rows)
    assert sum(r["length"] for r in got) == sum(len(tok.encode(t, add_special_tokens=False).ids) + 1 for t in texts)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for p, n in sorted(places):
            assert p == at
            at += n
        assert at <= 16
    four = [r for r in got if r["doc_id"] == 4]
    ids = tok.encode("one two three", add_special_tokens=False).ids + [0]
    assert [r["ids_crc32"] for r in four] == [zlib.crc32(np.asarray(ids, "<u4").tobytes())]
    assert sorted(r["piece"] for r in got if r["doc_id"] == 3) == sorted(2 * list(range(6)))
    assert pack(token_pieces(df.limit(0), tokenizer_path(), 16), 16).count() == 0
