"""Chat formatting: roles of a transcript's lines by a hidden Markov model.

A transcript is plain text in which turns follow each other, mostly (not
always) opened by a speaker marker such as ``User:``, ``### Assistant`` or
``<bot>``.  The hidden states are a role and whether a line opens its turn; a
line shows its marker's class, its length, whether a blank line precedes it and
how it ends.  Viterbi recovers the likeliest states of all lines, and the turns
are rendered in one canonical form.

The model's tables are counted, with add-one smoothing, on a bounded sample of
transcripts whose roles are known.  Transcripts in one row each are parsed next
to the scan, all of a batch advancing together; nothing is shuffled.

A long transcript may come in parts, a row each (``part``).  Its parts are parsed
as one: each part's best score from every first to every last state (a 6 x 6
table, products over max and plus) goes to its transcript, where a chain over
these tables fixes the parts' first and last states; then each part finds its best
path between them.  So no task holds more text than a part, and cutting changes no
line's role or turn.  A piece that goes on with a turn is rendered from a new line on.

Defined cases: a null or blank text has no turns and renders empty; a very long text in
one row is parsed whole by one task, about 200 bytes a line; a text
without any marker is parsed by its other features; of equally likely paths the one
whose last states come first in the order of states is taken; null keys and repeated rows
are parsed like any other, but parts of a null key are texts of their own; of rows that
repeat a key and a part each is a text of its own too; an empty table gives an empty
result; other columns are not read.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import CHUNK_BYTES, slices, table, tidy

ROLES = ("system", "user", "assistant")
#: names that speakers go by (ours), by role
NAMES = {"system": "system instruction instructions context note", "user": "user human question q customer prompt",
         "assistant": "assistant ai bot answer a model agent response"}
_CLASS = {n: i + 1 for i, role in enumerate(ROLES) for n in NAMES[role].split()}
MARKER = re.compile(r"[ \t]*(?:#{1,4}[ \t]*|<\|?|\[|\*\*)?(" + "|".join(sorted(_CLASS, key=len, reverse=True))
                    + r")(?:\|?>|\]|\*\*:?|[ \t]*:|[ \t]*$)[ \t]*", re.I)
#: length classes in characters, and how many values each feature has: marker, length, blank before, ending
LENGTHS = (1, 40, 120, 300)
SIZES = (len(ROLES) + 1, len(LENGTHS) + 1, 2, 3)
STATES = 2 * len(ROLES)     # 2 * role + (0 opens a turn, 1 goes on)

Line = tuple[str, int, int, int, int]   # text without marker, and the features


def read_lines(text: str | None) -> list[Line]:
    out, blank = [], 0
    for raw in (text or "").split("\n"):
        if not raw.strip():
            blank = 1
            continue
        m = MARKER.match(raw)
        body = (raw[m.end():] if m else raw).strip()
        n = sum(len(body) >= b for b in LENGTHS)
        end = 1 if body.endswith("?") else 2 if body.endswith((".", "!", ":")) else 0
        out.append((body, _CLASS[m[1].lower()] if m else 0, n, blank if out else 1, end))
        blank = 0
    return out


@dataclass
class Model:
    start: np.ndarray        # log, STATES
    move: np.ndarray         # log, STATES x STATES
    emit: list[np.ndarray]   # log, per feature STATES x values

    def scores(self, lines: list[Line]) -> np.ndarray:
        f = np.array([x[1:] for x in lines]).reshape(-1, len(SIZES))
        return sum(e[:, f[:, i]].T for i, e in enumerate(self.emit))


def fit(transcripts: list[list[tuple[str, str]]]) -> Model:
    """Counts from transcripts given as turns (role, raw text with its marker)."""
    start, move = np.zeros(STATES), np.ones((STATES, STATES))
    start[::2] = 1           # a transcript opens with an opening line
    emit = [np.ones((STATES, n)) for n in SIZES]
    for turns in transcripts:
        before = None
        for role, raw in turns:
            for i, line in enumerate(read_lines(raw)):
                state = 2 * ROLES.index(role) + (i > 0)
                features = list(line[1:])
                features[2] = 1 if i == 0 else line[3]   # turns are parted by a blank line
                for e, v in zip(emit, features):
                    e[state, v] += 1
                if before is None:
                    start[state] += 1
                else:
                    move[before, state] += 1
                before = state
    for role in range(len(ROLES)):      # a line goes on with its own turn only
        move[np.arange(STATES) // 2 != role, 2 * role + 1] = 0
    with np.errstate(divide="ignore"):
        return Model(np.log(start / start.sum()), np.log(move / move.sum(1, keepdims=True)),
                     [np.log(e / e.sum(1, keepdims=True)) for e in emit])


def viterbi(score: np.ndarray, begin: np.ndarray, size: np.ndarray, start: np.ndarray, move: np.ndarray,
            last: np.ndarray | None = None) -> np.ndarray:
    """The likeliest state of every row; chain i is rows begin[i] .. begin[i] + size[i].  ``start``:
    log scores of first states, of all chains or of each; ``last``: each chain's last state, if fixed."""
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    start = np.broadcast_to(start, (len(order), score.shape[1]))[order] if start.ndim > 1 else start
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), "left")
    best, back = np.empty_like(score), np.zeros(score.shape, np.int64)
    for i in range(longest):
        at = begin[:active[i]] + i
        if i == 0:
            best[at] = (start[:active[0]] if start.ndim > 1 else start) + score[at]
        else:
            way = best[at - 1][:, :, None] + move[None]
            back[at] = way.argmax(1)
            best[at] = way.max(1) + score[at]
    out = np.zeros(len(score), np.int64)
    for i in range(longest - 1, -1, -1):
        at = begin[:active[i]] + i
        end = size[:active[i]] == i + 1
        nxt = np.minimum(at + 1, len(score) - 1)
        final = best[at].argmax(1) if last is None else last[order][:active[i]]
        out[at] = np.where(end, final, back[nxt, out[nxt]])
    return out


def spans_score(score: np.ndarray, begin: np.ndarray, size: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Chain x first state x last state: the best score of a path between these."""
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    active = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), "left")
    m = np.where(np.eye(score.shape[1], dtype=bool), score[np.minimum(begin, max(0, len(score) - 1))][:, None, :], -np.inf)
    for i in range(1, len(active)):
        n = active[i]
        m[:n] = (m[:n, :, :, None] + move).max(2) + score[begin[:n] + i][:, None, :]
    out = np.empty_like(m)
    out[order] = m
    return out


def _lines(column) -> tuple[list[list[Line]], np.ndarray, np.ndarray, list[Line]]:
    found = [read_lines(t) for t in column.to_pylist()]
    size = np.array([len(f) for f in found], np.int64)
    return found, np.cumsum(size) - size, size, [x for f in found for x in f]


def _turns(lines: list[Line], states: np.ndarray) -> list[dict]:
    got: list[dict] = []
    for line, s in zip(lines, states):
        if s % 2 == 0 or not got:
            got.append({"role": ROLES[s // 2], "text": [], "goes_on": bool(s % 2)})
        if line[0]:
            got[-1]["text"].append(line[0])
    return [t | {"text": "\n".join(t["text"])} for t in got]


TURNS = "array<struct<role: string, text: string, goes_on: boolean>>"


def parse(df: DataFrame, model: Model, *, key: str = "conv_id", text: str = "text", part: str | None = None) -> DataFrame:
    """A row per row of ``df``: key (and ``part``), ``turns`` (role, text, and whether it goes on from
    the part before) and ``rendered``.  With ``part``, a number, rows of one key are one transcript
    in its order, and their ``rendered`` texts follow each other."""
    kind = df.schema[key].dataType.simpleString()
    texts = df.select(F.col(key).alias("k"), *([F.col(part).cast("long").alias("p")] if part else []), F.col(text).cast("string").alias("t"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("goes_on", pa.bool_())]))
        names = [key, *([part] if part else []), "turns", "rendered"]
        for whole in batches:
            sizes = pc.fill_null(pc.binary_length(whole.column("t")), 0).to_pylist()
            for lo, hi in slices(sizes, CHUNK_BYTES):
                b = whole.slice(lo, hi - lo)
                found, begin, size, lines = _lines(b.column("t"))
                start, last, more = model.start, None, [False] * b.num_rows
                if part:
                    first, last, after = (b.column(c).fill_null(-1).to_numpy() for c in ("first", "last", "after"))
                    start = np.where(np.arange(STATES) == first[:, None], 0, -np.inf)
                    more = after % 2 == 1       # the next part goes on with this one's turn
                state = viterbi(model.scores(lines), begin, size, start, model.move, last) if lines else np.empty(0, np.int64)
                turns = [_turns(f, state[at:at + len(f)]) for f, at in zip(found, begin)]
                keys = [b.column(c) for c in (["k", "p"] if part else ["k"])]
                text_out = [render(t, bool(m)) for t, m in zip(turns, more)]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(turns, turn), pa.array(text_out, pa.string())], names=names)

    if not part:
        return texts.mapInArrow(tidy(run), f"`{key}` {kind}, turns {TURNS}, rendered string")
    texts = table(texts.withColumn("i", F.monotonically_increasing_id()), "parts")
    ways = texts.join(_chained(_part_scores(texts, model), model), "i", "left")
    return ways.select("k", "p", "t", "first", "last", "after") \
        .mapInArrow(tidy(run), f"`{key}` {kind}, `{part}` long, turns {TURNS}, rendered string")


def _part_scores(texts: DataFrame, model: Model) -> DataFrame:
    """(i, k, p, m): the table of each part that has lines."""
    kind = texts.schema["k"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        for whole in batches:
            sizes = pc.fill_null(pc.binary_length(whole.column("t")), 0).to_pylist()
            for lo, hi in slices(sizes, CHUNK_BYTES):
                b = whole.slice(lo, hi - lo)
                _, begin, size, lines = _lines(b.column("t"))
                if lines:
                    have = np.flatnonzero(size)
                    m = spans_score(model.scores(lines), begin[have], size[have], model.move).reshape(len(have), -1)
                    at = pa.array(have)
                    yield pa.RecordBatch.from_arrays([b.column(c).take(at) for c in "ikp"] + [pa.array(list(m), pa.list_(pa.float64()))],
                                                     names=["i", "k", "p", "m"])

    return texts.select("i", "k", "p", "t").mapInArrow(tidy(run), f"i long, k {kind}, p long, m array<double>")


def _single(parts: list[dict]) -> list[list[dict]]:
    """The chains among parts in order: repeated ones each alone, and the others."""
    times = Counter(x["p"] for x in parts)
    rest = [x for x in parts if times[x["p"]] == 1]
    return [[x] for x in parts if times[x["p"]] > 1] + ([rest] if rest else [])


def _chained(parts: DataFrame, model: Model) -> DataFrame:
    """(i, first, last, after): the first and last state of each part, and the first of the part after."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            out: list[tuple] = []
            for chain in (c for parts in b.column(0).to_pylist() for c in _single(parts)):
                tables = [np.array(x["m"]).reshape(STATES, STATES) for x in chain]
                score, ways = model.start, []
                for n, m in enumerate(tables):
                    enter = score if n == 0 else (score[:, None] + model.move).max(0)
                    source = np.zeros(STATES, np.int64) if n == 0 else (score[:, None] + model.move).argmax(0)
                    total = enter[:, None] + m
                    ways.append((total.argmax(0), source))
                    score = total.max(0)
                last, after = int(score.argmax()), 0
                for x, (first_of, source) in zip(reversed(chain), reversed(ways)):
                    first = int(first_of[last])
                    out.append((x["i"], first, last, after))
                    last, after = int(source[first]), first
            cols = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), *[pa.int32()] * 3))],
                                             names=["i", "first", "last", "after"])

    # a transcript's parts, 36 numbers each; null keys and parts stand alone
    rows = parts.withColumn("alone", F.when(F.col("k").isNull() | F.col("p").isNull(), F.col("i")))
    chains = rows.groupBy("k", "alone").agg(F.sort_array(F.collect_list(F.struct("p", "i", "m"))).alias("c"))
    return chains.select("c").mapInArrow(tidy(run), "i long, first int, last int, after int")


def render(turns: list[dict], more: bool = False) -> str:
    """``more``: the last turn goes on in the next part, which closes it."""
    out = "".join((t["text"] and f"\n{t['text']}" if t["goes_on"] else f"<|im_start|>{t['role']}\n{t['text']}") + "<|im_end|>\n" for t in turns)
    return out.removesuffix("<|im_end|>\n") if more else out


#: ways to open a turn, by role in the order of ROLES; one is chosen per conversation
STYLES = (("System: ", "User: ", "Assistant: "), ("Instruction: ", "Human: ", "AI: "), ("Note: ", "Q: ", "A: "),
          ("### System\n", "### User\n", "### Assistant\n"), ("<system> ", "<user> ", "<bot> "))
#: one turn in so many is left unmarked, and turns of a part (a row, so that no row grows with a conversation)
UNMARKED, PART = 8, 64


def as_transcripts(df: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """Raw transcripts from a table of turns: conv, ``part``, ``text`` and ``gold``
    (role and raw text of each turn).  Turns follow their number; a row that is
    repeated as a whole counts once; rows without conversation or number stand alone;
    null roles count as user; a conversation longer than PART turns has several parts."""
    alone = F.col(conv).isNull() | F.col(turn).isNull()
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    r = F.when(F.col(role).isin(*ROLES), F.col(role)).otherwise(F.lit("user"))
    rows = df.select(F.col(conv).alias("c"), F.col(turn).cast("long").alias("n"), r.alias("r"), t.alias("t"),
                     F.when(alone, F.xxhash64(F.col(turn), r, t)).otherwise(F.floor(F.col(turn) / PART)).alias("part")).distinct()
    style = F.array(*[F.array(*map(F.lit, s)) for s in STYLES])
    mark = F.get(F.get(style, F.pmod(F.xxhash64("c"), F.lit(len(STYLES))).cast("int")),
                 F.when(F.col("r") == ROLES[0], 0).when(F.col("r") == ROLES[1], 1).otherwise(2))
    mark = F.when((F.col("n") > 0) & (F.pmod(F.xxhash64("c", "n"), F.lit(UNMARKED)) == 0), F.lit("")).otherwise(mark)
    raw = F.concat(mark, F.col("t"))
    got = rows.groupBy("c", "part").agg(F.array_sort(F.collect_list(F.struct("n", F.col("r").alias("role"), raw.alias("raw")))).alias("g"))
    gold = F.transform("g", lambda x: F.struct(x["role"].alias("role"), x["raw"].alias("raw")))
    return got.select(F.col("c").alias(conv), "part", F.array_join(F.transform("g", lambda x: x["raw"]), "\n\n").alias("text"),
                      gold.alias("gold"))


def train(transcripts: DataFrame, *, key: str = "conv_id", most: int = 300) -> Model:
    """A model from the ``most`` transcripts with the least key hashes, outside
    the held-out fold (crc32 of the key as text, modulo 5, is 0)."""
    rows = transcripts.where((F.crc32(F.col(key).cast("string")) % 5 != 0) & (F.size("gold") <= PART)) \
        .orderBy(F.xxhash64(F.col(key)), "part").limit(most).select("gold").collect()
    return fit([[(t.role, t.raw) for t in r.gold] for r in rows])
