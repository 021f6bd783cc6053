"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are folded (lower case, white space to single blanks).  An item
of n characters may lie in a document with up to ``budget`` edits, a share
``RATE`` of n.  Cut into budget + 1 pieces, one piece must then stand there
unchanged: an Aho-Corasick automaton over all pieces finds the exact piece hits
in one pass over the text, each hit fixes the neighbourhood where the item would
lie, and Myers' bit-parallel distance verifies the neighbourhood.

Documents are only scanned, never shuffled.  Items travel with the tasks in
blocks of ``BLOCK`` bytes.  A benchmark of one block is one scan; a larger one is
worked off block by block, each with its scan and its written result, so driver and
workers hold one block at a time.  An item shorter than ``LEAST`` characters must
occur exactly and between non-letters.

Defined cases: null or empty texts and items match nothing; a very long text is
matched whole, in one pass; an item that lies in a text several times is reported once,
at its least distance, the first of equal ones; null keys and
repeated rows are reported row by row; repeated items one by one, with their ids
in the column's own type; items with a null id only if asked for; an empty
table gives an empty result; other columns are not read.
"""
from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import table, tidy

RATE, LEAST, BLOCK = 0.05, 24, 4 << 20


def fold(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget`` + 1 consecutive parts of like length: (start, part)."""
    n, parts = len(item), budget + 1
    cuts = [n * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str, budget: int) -> tuple[int, int] | None:
    """(distance, end) of the best place of ``pattern`` in ``text``, the first
    of equal ones; None beyond ``budget``.  One word operation set per character."""
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, last = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, None
    for end, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(horizontal | plus) & full
        down = plus & horizontal
        score += bool(up & last) - bool(down & last)
        up = up << 1 & full
        plus = (down << 1 | ~(vertical | up)) & full
        minus = up & vertical
        if score <= budget and (best is None or score < best[0]):
            best = (score, end)
    return best


class Matcher:
    """The piece automaton of a block of items (id, folded text)."""

    def __init__(self, items: list[tuple[object, str]], rate: float):
        import ahocorasick
        self.items = [(i, t, int(rate * len(t)) if len(t) >= LEAST else 0) for i, t in items if t]
        places: dict[str, list] = {}
        for at, (_, t, budget) in enumerate(self.items):
            for start, part in pieces(t, budget):
                places.setdefault(part, []).append((at, start))
        self.automaton = ahocorasick.Automaton()
        for part, where in places.items():
            self.automaton.add_word(part, (len(part), where))
        if places:
            self.automaton.make_automaton()

    def __call__(self, text: str) -> list[tuple[object, int, int, int]]:
        """(item id, distance, length, end in the folded text) of every item that lies in ``text``."""
        if not self.items or not text:
            return []
        near: dict[int, list[tuple[int, int]]] = {}
        for last, (n, where) in self.automaton.iter(text):
            for at, start in where:
                _, item, budget = self.items[at]
                begin = last + 1 - n - start
                lo, hi = max(0, begin - budget), min(len(text), begin + len(item) + budget)
                spans = near.setdefault(at, [])
                if spans and lo <= spans[-1][1]:
                    spans[-1] = (min(lo, spans[-1][0]), max(hi, spans[-1][1]))
                else:
                    spans.append((lo, hi))
        out = []
        for at, spans in near.items():
            ident, item, budget = self.items[at]
            best = None
            for lo, hi in spans:
                if len(item) < LEAST:
                    ok = not (text[lo - 1:lo].isalpha() or text[hi:hi + 1].isalpha())
                    got = (0, len(item)) if ok and text[lo:hi] == item else None
                else:
                    got = myers(item, text[lo:hi], budget)
                if got and (best is None or got[0] < best[0]):
                    best = (got[0], lo + got[1])
            if best:
                out.append((ident, best[0], len(item), best[1]))
        return out


def contaminated(df: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", item: str = "item_id",
                 item_text: str = "text", rate: float = RATE, block: int = BLOCK,
                 null_items: bool = False) -> DataFrame:
    """A row per document and item that lies in it: key, item, ``distance``,
    ``n_chars`` (of the folded item) and ``end`` (in the folded text).
    ``null_items``: items without an id are matched too."""
    from pyspark.sql.pandas.types import to_arrow_type
    kind = df.schema[key].dataType.simpleString()
    rows = benchmark.where(F.col(item_text).isNotNull()).select(
        F.col(item).alias("i"), F.col(item_text).cast("string").alias("t"))
    if not null_items:
        rows = rows.where(F.col("i").isNotNull())
    ident = benchmark.schema[item].dataType
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-total // block))
    rows = rows.withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(blocks)))

    def scan(items: list[tuple[object, str]]) -> DataFrame:
        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa
            match = Matcher(items, rate)
            for b in batches:
                at, got = [], []
                for n, t in enumerate(b.column(1)):
                    found = match(fold(t.as_py()))
                    at += [n] * len(found)
                    got += found
                cols = list(zip(*got)) if got else [[]] * 4
                kinds = [to_arrow_type(ident), *[pa.int64()] * 3]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64()))]
                                                 + [pa.array(c, t) for c, t in zip(cols, kinds)],
                                                 names=[key, item, "distance", "n_chars", "end"])

        return df.select(F.col(key), F.col(text).cast("string")).mapInArrow(
            tidy(run), f"`{key}` {kind}, `{item}` {ident.simpleString()}, distance long, n_chars long, end long")

    out = None
    for b in range(blocks):   # a block of items at a time: `block` bytes
        items = sorted(((r.i, fold(r.t)) for r in rows.where(F.col("b") == b).collect()),
                       key=lambda x: (x[0] is None, 0 if x[0] is None else x[0], x[1]))
        part = scan(items) if blocks == 1 else table(scan(items), "block")
        out = part if out is None else out.unionByName(part)
    return out
