"""Transcript parsing: Viterbi against enumeration, held-out roles, edges."""
import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from sparkmart.llm.chat_hmm import STATES, as_transcripts, fit, parse, read_lines, train, viterbi
from sparkmart.llm.queries import QUERIES


@pytest.mark.parametrize("seed", range(5))
def test_viterbi_is_the_best_path(seed):
    rng = np.random.default_rng(seed)
    sizes, states = [3, 1, 5, 2], 3
    score, start, move = rng.normal(size=(sum(sizes), states)), rng.normal(size=states), rng.normal(size=(states, states))
    begin = np.cumsum(sizes) - sizes
    got = viterbi(score, begin, np.array(sizes), start, move)
    for b, n in zip(begin, sizes):
        best = max(itertools.product(range(states), repeat=n), key=lambda p: start[p[0]] + sum(
            score[b + i, y] for i, y in enumerate(p)) + sum(move[a, c] for a, c in zip(p, p[1:])))
        assert tuple(got[b:b + n]) == best


def test_held_out_roles(spark):
    sf = "/root/testdata/sf0.1"
    raw = as_transcripts(spark.read.parquet(f"{sf}/conversations.parquet"))
    gold = {(r.conv_id, r.part): ",".join(t.role for t in r.gold) for r in raw.collect()}
    got = {(r.conv_id, r.part): r for r in QUERIES["op6_chat_hmm"](spark, sf).collect()}
    assert set(got) == set(gold)
    held = [k for k in gold if zlib.crc32(str(k[0]).encode()) % 5 == 0]
    assert len(held) > 50
    assert sum(got[k].roles == gold[k] for k in held) >= 0.95 * len(held)
    assert all(r.n_turns == r.rendered.count("<|im_start|>") for r in got.values())


TURNS = [[("system", "Note: be short."), ("user", "User: What is it?\nTell me."), ("assistant", "Assistant: A thing.\nNothing more."),
          ("user", "User: Why?"), ("assistant", "Assistant: Just so.")]] * 20


def test_lines_and_edges(spark):
    assert [x[:2] for x in read_lines("### User\nhi\n\n<bot> yes\nAI is: no\nQ:why?")] == [
        ("", 2), ("hi", 0), ("yes", 3), ("AI is: no", 0), ("why?", 2)]
    model = fit(TURNS)
    schema = T.StructType([T.StructField(c, t) for c, t in (("conv_id", T.LongType()), ("text", T.StringType()),
                                                            ("turns", T.StringType()), ("part", T.StringType()))])
    long = "\n\n".join(r for t in TURNS * 40 for _, r in t)
    rows = [(1, "\n\n".join(r for _, r in TURNS[0]), "x", None), (2, None, None, None), (3, " \n\t\n", None, None),
            (None, "User: a?\n\nAssistant: b.", None, None), (None, "User: a?\n\nAssistant: b.", None, None),
            (5, long, None, None), (6, "no marker here", None, None)]
    df = spark.createDataFrame(rows, schema)
    got = parse(df, model).collect()
    one = next(r for r in got if r.conv_id == 1)
    assert [(t.role, t.text) for t in one.turns] == [
        ("system", "be short."), ("user", "What is it?\nTell me."), ("assistant", "A thing.\nNothing more."),
        ("user", "Why?"), ("assistant", "Just so.")]
    assert one.rendered.startswith("<|im_start|>system\nbe short.<|im_end|>\n")
    assert {(r.rendered, len(r.turns)) for r in got if r.conv_id in (2, 3)} == {("", 0)}
    assert [[t.role for t in r.turns] for r in got if r.conv_id is None] == [["user", "assistant"]] * 2
    assert len(next(r for r in got if r.conv_id == 5).turns) == 4000
    assert len(next(r for r in got if r.conv_id == 6).turns) == 1
    assert parse(df.limit(0), model).count() == 0
    assert fit([]).move.shape == (STATES, STATES)


@pytest.mark.parametrize("seed", range(3))
def test_parts_are_parsed_as_one(spark, seed):
    """A transcript cut anywhere between lines gives the same turns."""
    rng = np.random.default_rng(seed)
    model = fit(TURNS)
    model.emit = [e + rng.normal(size=e.shape) / 100 for e in model.emit]       # no two paths are equally likely
    texts, cut = {}, []
    for k in range(12):
        lines = [str(rng.choice(["User: why?", "Assistant: so.", "and more", "It is.", "what?", "Note: x", "", "### User"])) for _ in range(rng.integers(1, 60))]
        texts[k] = "\n".join(lines)
        at = 0
        for p in range(20):
            n = int(rng.integers(0, 9)) if p < 19 else len(lines)
            cut.append((k, p, "\n".join(lines[at:at + n])))
            at += n
    # a part's first line counts as standing behind a blank line, so the whole is read part by part too
    score = {k: [x for kk, _, t in cut if kk == k for x in read_lines(t)] for k in texts}
    got = parse(spark.createDataFrame(cut, "conv_id long, part int, text string"), model, part="part").collect()
    for k, lines in score.items():
        rows = sorted((r for r in got if r.conv_id == k), key=lambda r: r.part)
        want = [] if not lines else viterbi(model.scores(lines), np.array([0]), np.array([len(lines)]), model.start, model.move)
        turns = []
        for line, s in zip(lines, want):
            if s % 2 == 0:
                turns.append([s // 2, []])
            turns[-1][1] += [line[0]] if line[0] else []
        merged = []
        for r in rows:
            for t in r.turns:
                if not t.goes_on:
                    merged.append([["system", "user", "assistant"].index(t.role), []])
                merged[-1][1] += [t.text] if t.text else []
        assert [(a, "\n".join(b)) for a, b in merged] == [(a, "\n".join(b)) for a, b in turns]
        text = "".join(r.rendered for r in rows)
        assert text.count("<|im_start|>") == text.count("<|im_end|>") == len(turns)


def test_parts_without_key_or_twice(spark):
    model = fit(TURNS)
    rows = [(None, 0, "User: a?"), (None, 0, "Assistant: b."), (1, 0, "User: a?"), (1, 0, "User: a?"), (1, 1, "Assistant: c."), (2, None, "User: z?"), (3, 5, None)]
    got = parse(spark.createDataFrame(rows, "conv_id long, part int, text string"), model, part="part").collect()
    assert len(got) == len(rows) and sorted(len(r.turns) for r in got) == [0] + [1] * 6
    empty = spark.createDataFrame([], "conv_id long, part int, text string")
    assert parse(empty, model, part="part").count() == 0


def test_transcripts_of_odd_tables(spark):
    schema = "conv_id long, turn int, role string, text string, part string"
    rows = [(1, 1, "assistant", "b", None), (1, 0, "user", "a", None), (1, 0, "user", "a", None), (None, 0, "user", "x", None),
            (None, None, None, None, None), (2, None, "robot", "y", "p"), *[(3, i, "user", f"t{i}", None) for i in range(130)]]
    got = as_transcripts(spark.createDataFrame(rows, schema)).collect()
    assert [[t.role for t in r.gold] for r in got if r.conv_id == 1] == [["user", "assistant"]]
    assert sorted(len(r.gold) for r in got if r.conv_id == 3) == [2, 64, 64]
    assert sorted(len(r.gold) for r in got if r.conv_id is None) == [1, 1]
    empty = spark.createDataFrame([], schema)
    assert as_transcripts(empty).count() == 0
    assert parse(as_transcripts(empty).select("conv_id", "text"), train(as_transcripts(empty))).count() == 0
