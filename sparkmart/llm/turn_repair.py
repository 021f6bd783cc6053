"""Conversation structure repair by prefix-doubling path ranking.

A conversation's rows, in order of turn, become an optional system turn and
then pairs of user and assistant by the cheapest edits: keep (K), rerole (R),
delete (D), insert (I).  What may follow is an automaton of four states (start,
after system, after user, after assistant); a node is a place between two rows
and a state, an arc an edit.

1. Costs.  A row's edits are a 4 x 4 matrix over (min, +).  Conversations are
   cut into blocks of ``BLOCK`` rows; each block's product says what it costs
   from every state to every other, and a conversation's products, from its end
   on, give each block the costs that remain behind it.  Inside a block the
   costs of all nodes follow backwards, many blocks advancing together.
2. Ranks.  Arcs that keep a node's cost are optimal.  Nodes are ranked by the
   first 1, 2, 4, ... letters of their least audit: the rank for twice the
   length is that of the pair (rank, rank of the node that many letters on).
   Of a node's arcs that with the least (letter, rank of its end) is taken, and
   doubled pointers read the audit off.  In this automaton a letter leads to one
   node only, so the least audit of a block does not depend on the next block's.
3. The blocks' audits, one for each state a block may be entered in, are
   strung together; at last texts and edits meet in order of turn.

Positions come from one range exchange of narrow rows, and repeats are found by
a partial aggregate, so neither a long conversation nor a text that a third of
the rows share meets in one task.  Only the hash of a conversation's repaired
text, one sequential function, reads that conversation's rows in one task; it
does so row by row, in constant memory beside the audit (a letter an edit).

Defined cases: a null role or text counts as one space, so it is blank or of no
known initial; a null conversation key is a conversation; null turns stand
first; rows of one turn stand in order of role, then of the SHA-256 of the text
(equal rows are interchangeable); texts of equal SHA-256 are equal; a very long
text is one row like any other and travels twice, to be hashed and to be
joined; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import positioned, small, table, tidy

#: rows of a block, and nodes that a task works on at a time
BLOCK, NODES = 4096, 1 << 18

# fixed values: characters that part words, ends of a sentence, costs of edits
GAPS, ENDS = " \t\n\x0b\x0c\r", ".!?"
DELETE, REROLE, INSERT, CUT = 3, 2, 2, 1

LETTERS = b"\0DIKR"                       # 0: the audit ends
START, SYSTEM, USER, ASSISTANT = range(4)
FAR = 1 << 40
# the state after a row of initial s, u, a, another one; and after a turn written by an edit
_AFTER = np.array([[SYSTEM, -1, -1, -1], [USER, USER, -1, USER], [-1, -1, ASSISTANT, -1], [-1] * 4])
_WRITTEN = np.array([USER, USER, ASSISTANT, USER])
_ROLE = {USER: "user", ASSISTANT: "assistant"}


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(-2), FAR)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By row code (initial + 4 if to be deleted + 8 if cut off; 16: no row): the end of each
    letter's arc from each state (-1: none), its cost, the product with insertions; and the
    costs of insertions alone."""
    end = np.full((17, 5, 4), -1)
    cost = np.zeros((17, 5), np.int64)
    insert = np.where(np.eye(4, dtype=bool), 0, FAR)
    for _ in range(3):
        step = np.full((4, 4), FAR)
        step[range(4), _WRITTEN] = INSERT
        insert = np.minimum(insert, _times(insert, np.minimum(step, np.where(np.eye(4, dtype=bool), 0, FAR))))
    step = np.full((17, 4, 4), FAR)
    for code in range(16):
        end[code, 1], cost[code, 1] = range(4), DELETE
        if not code & 4:
            cut = CUT if code & 8 else 0
            end[code, 3], cost[code, 3] = _AFTER[code & 3], cut
            end[code, 4], cost[code, 4] = _WRITTEN, REROLE + cut
        for letter in (1, 3, 4):
            for q in range(4):
                if end[code, letter, q] >= 0:
                    at = code, q, end[code, letter, q]
                    step[at] = min(step[at], cost[code, letter])
    step[:16] = _times(insert, step[:16])
    step[16] = np.where(np.eye(4, dtype=bool), 0, FAR)
    end[:16, 2], cost[:, 2] = _WRITTEN, INSERT
    return end, cost, step, insert


_END, _COST, _STEP, _INSERT = _tables()
#: what remains to be paid behind the last row, by state
_CLOSE = np.minimum(_INSERT[:, START], _INSERT[:, ASSISTANT])


def _groups(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Blocks of like length, so many that their padded nodes stay within ``NODES``."""
    order = np.argsort(sizes, kind="stable")
    lo = 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and (hi - lo + 1) * 4 * (sizes[order[hi]] + 1) <= NODES:
            hi += 1
        yield order[lo:hi]
        lo = hi


def _padded(codes: list[np.ndarray]) -> np.ndarray:
    """One row per block, filled up in front with the code of no row."""
    out = np.full((len(codes), max(map(len, codes))), 16)
    for row, c in zip(out, codes):
        row[len(row) - len(c):] = c
    return out


def products(codes: np.ndarray) -> np.ndarray:
    """(min, +) products of the rows' matrices of each (padded) block."""
    m = np.broadcast_to(_STEP[16], (len(codes), 4, 4))
    for column in codes.T:
        m = _times(m, _STEP[column])
    return m


def _dense(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Ranks from 0 of the pairs (a, b)."""
    return np.unique(a * (b.max() + 1) + b, return_inverse=True)[1]


def least_paths(target: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """For each node the first letter of its least string (0: it ends here), and pointers 1, 2,
    4, ... letters on.  ``target``: node x letter, the end of an arc or -1; letter 0 is no arc."""
    n = len(target)
    nodes = np.arange(n)
    there = target >= 0
    first = np.where(there.any(1), there.argmax(1), 0)
    rank, ahead = first, np.where(first > 0, target[nodes, first], nodes)
    while (ahead != ahead[ahead]).any():
        rank, ahead = _dense(rank, rank[ahead]), ahead[ahead]
    rank = _dense(rank, rank[ahead])
    letters = np.arange(target.shape[1])
    letter = np.where(there, letters * n + rank[np.maximum(target, 0)], target.shape[1] * n).argmin(1)
    hops = [np.where(letter > 0, target[nodes, letter], nodes)]
    while (hops[-1] != hops[-1][hops[-1]]).any():
        hops.append(hops[-1][hops[-1]])
    return letter, hops


def audits(codes: np.ndarray, sizes: np.ndarray, close: np.ndarray, last: np.ndarray) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
    """Of each (padded) block, by the state it is entered in: the least audit, the state it is
    left in, and the cost that remains.  ``close``: cost behind the block; ``last``: of its conversation."""
    blocks, width = codes.shape
    h = np.empty((blocks, width + 1, 4), np.int64)
    h[:, width] = close
    for i in range(width - 1, -1, -1):
        h[:, i] = np.minimum((_STEP[codes[:, i]] + h[:, i + 1, None, :]).min(2), FAR)
    padded = np.concatenate((codes, np.full((blocks, 1), 16)), 1)
    node = np.arange(h.size).reshape(h.shape)
    target = np.full((*h.shape, 5), -1)
    for letter in range(1, 5):
        end = _END[padded, letter]                                  # block x place x state
        if letter == 2:
            end[last, width] = _WRITTEN
        later = np.roll(h, -1, 1) if letter != 2 else h
        at = np.maximum(end, 0)
        pays = _COST[padded, letter][..., None] + np.take_along_axis(later, at, 2)
        good = (end >= 0) & (pays == h) & (h < FAR)
        target[..., letter] = np.where(good, node[:, :, :1] + at + (0 if letter == 2 else 4), -1)
    letter, hops = least_paths(target.reshape(-1, 5))
    entry = node[np.arange(blocks), width - sizes].reshape(-1)
    path = entry[:, None]
    for hop in hops:
        path = np.concatenate((path, hop[path]), 1)
    text = np.frombuffer(LETTERS, np.uint8)[letter[path]]
    strings = [row.tobytes().rstrip(b"\0").decode() for row in text]
    leave = hops[-1][entry] % 4
    return [strings[i:i + 4] for i in range(0, len(strings), 4)], leave.reshape(-1, 4), h[np.arange(blocks), width - sizes]


def _codes(column) -> list[np.ndarray]:
    flat, at = column.values.to_numpy(), column.offsets.to_numpy()
    return [flat[a:z] for a, z in zip(at, at[1:])]


def _block_costs(blocks: DataFrame) -> DataFrame:
    """(c, b, m, first, last, illegal) of each block."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            codes = _codes(batch.column(2))
            m = np.empty((len(codes), 16), np.int64)
            for g in _groups(np.array([len(c) for c in codes])):
                m[g] = products(_padded([codes[i] for i in g])).reshape(-1, 16)
            initials = [c & 3 for c in codes]
            wrong = [illegal(c) for c in initials]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(m), pa.list_(pa.int64())),
                                              pa.array([int(c[0]) for c in initials], pa.int32()),
                                              pa.array([int(c[-1]) for c in initials], pa.int32()), pa.array(wrong, pa.int64())],
                                             names=["c", "b", "m", "first", "last", "illegal"])

    return blocks.mapInArrow(tidy(run), "c string, b long, m array<long>, first int, last int, illegal long")


def illegal(initials: np.ndarray) -> int:
    """Neighbours other than su, ua, au."""
    pair = initials[:-1] * 4 + initials[1:]
    return int((~np.isin(pair, (0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1))).sum())


def _behind(costs: DataFrame) -> DataFrame:
    """(c, b, close, end): the cost that remains behind each block, by state."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            out: list[tuple] = []
            for c, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                close = _CLOSE
                for i, p in enumerate(reversed(parts)):
                    out.append((c, p["b"], close.tolist(), i == 0))
                    close = np.minimum((np.array(p["m"]).reshape(4, 4) + close).min(1), FAR)
            c, b, close, end = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()), pa.array(b, pa.int64()), pa.array(close, pa.list_(pa.int64())),
                                              pa.array(end, pa.bool_())], names=["c", "b", "close", "end"])

    # of a conversation, 17 numbers for every BLOCK rows
    parts = costs.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("b", "m"))).alias("p"))
    return parts.mapInArrow(tidy(run), "c string, b long, close array<long>, end boolean")


def _block_audits(blocks: DataFrame) -> DataFrame:
    """(c, b, audits, leave, cost) by the state a block is entered in."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            codes = _codes(batch.column(2))
            close = np.array(batch.column(3).to_pylist(), np.int64).reshape(-1, 4)
            last = np.array(batch.column(4).to_pylist(), bool)
            sizes = np.array([len(c) for c in codes], np.int64)
            for g in _groups(sizes):
                text, leave, cost = audits(_padded([codes[i] for i in g]), sizes[g], close[g], last[g])
                at = pa.array(g)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(text, pa.list_(pa.string())),
                     pa.array(leave.tolist(), pa.list_(pa.int32())), pa.array(cost[:, START], pa.int64())],
                    names=["c", "b", "audits", "leave", "cost"])

    return blocks.mapInArrow(tidy(run), "c string, b long, audits array<string>, leave array<int>, cost long")


def _strung(parts: DataFrame) -> DataFrame:
    """(c, cost, audit, illegal): each conversation's blocks, followed from the start."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            cost, text, wrong = [], [], []
            for parts in batch.column(1).to_pylist():
                state, letters = START, []
                for p in parts:
                    letters.append(p["audits"][state])
                    state = p["leave"][state]
                border = np.array([(p["last"], n["first"]) for p, n in zip(parts, parts[1:])], np.int64).reshape(-1, 2)
                cost.append(parts[0]["cost"])
                text.append("".join(letters))
                wrong.append(sum(p["illegal"] for p in parts) + sum(illegal(x) for x in border))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cost, pa.int64()), pa.array(text, pa.string()),
                                              pa.array(wrong, pa.int64())], names=["c", "cost", "audit", "illegal"])

    fields = F.struct("b", "audits", "leave", "cost", "first", "last", "illegal")
    got = parts.groupBy("c").agg(F.sort_array(F.collect_list(fields)).alias("p"))   # an audit's letters, as the result
    return got.mapInArrow(tidy(run), "c string, cost long, audit string, illegal long")


class _Writer:
    """The repaired text of one conversation, row by row, into a hash."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.any, self.hash = audit, 0, START, False, hashlib.sha256()

    def line(self, role: str, text: str) -> None:
        self.hash.update((f"\n{role}:{text}" if self.any else f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.any = True

    def inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.state = int(_WRITTEN[self.state])
            self.line(_ROLE[self.state], "")

    def row(self, role: str, text: str) -> None:
        self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = int(_AFTER["sua".index(role[:1]), self.state])
            self.line(role, text)
        elif edit == "R":
            self.state = int(_WRITTEN[self.state])
            self.line(_ROLE[self.state], text)

    def digest(self) -> str:
        self.inserted()
        return self.hash.hexdigest()


def _hashes(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(c, repaired_sha256)."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        now = writer = None
        for batch in batches:
            keys, got = [], []
            for c, audit, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if audit is not None:
                    if writer is not None:
                        keys.append(now)
                        got.append(writer.digest())
                    now, writer = c, _Writer(audit)
                else:
                    writer.row(role, text)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(got, pa.string())], names=["c", "repaired_sha256"])
        if writer is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([writer.digest()])], names=["c", "repaired_sha256"])

    both = edits.select("c", "audit").unionByName(rows.select("c", "turn", "role", "text", "h"), allowMissingColumns=True)
    order = ["c", F.col("audit").isNull(), F.asc_nulls_first("turn"), "role", "h"]
    return both.repartition("c").sortWithinPartitions(*order).select("c", "audit", "role", "text") \
        .mapInArrow(tidy(run), "c string, repaired_sha256 string")


def _key(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), c.cast("string")))


def repair(df: DataFrame, everyone: DataFrame | None = None, *, key: str = "conv_id", turn: str = "turn",
           role: str = "role", text: str = "text") -> DataFrame:
    """A row per conversation: key, ``gaps`` (missing turn numbers), rows that are ``blank``,
    ``duplicate``, ``truncated``, ``illegal`` neighbours, ``cost``, ``audit`` and
    ``repaired_sha256``.  ``everyone``: a table whose keys are all reported, also those
    without rows in ``df``."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = df.select(_key(F.col(key)).alias("c"), F.col(turn).cast("long").alias("turn"), space(role).alias("role"),
                     space(text).alias("text")).withColumn("h", F.unhex(F.sha2("text", 256)))
    body = F.rtrim("text", F.lit(GAPS))
    letter = F.substring("role", 1, 1)
    initial = F.when(letter == "s", 0).when(letter == "u", 1).when(letter == "a", 2).otherwise(3)
    narrow = rows.select("c", "turn", "role", "h", (body == "").alias("blank"), initial.alias("initial"),
                         (~F.substring(body, -1, 1).isin(*ENDS)).alias("cut"))
    placed = positioned(narrow.withColumn("u", F.monotonically_increasing_id()), ["c", "turn", "role", "h", "u"], "turns", "at")
    again = table(placed.where(~F.col("blank")).groupBy("c", "role", "h").agg(F.min("at").alias("lead"), F.count(F.lit(1)).alias("n"))
                  .where("n > 1").drop("n"), "again")
    placed = placed.join(small(again), ["c", "role", "h"], "left")
    copy = ~F.col("blank") & F.coalesce(F.col("at") > F.col("lead"), F.lit(False))
    cut = ~F.col("blank") & ~copy & F.col("cut")
    placed = placed.select("c", "turn", "at", "blank", copy.alias("copy"), cut.alias("cut"),
                           (F.col("initial") + F.when(F.col("blank") | copy, 4).otherwise(0) + F.when(cut, 8).otherwise(0))
                           .cast("int").alias("code"))
    one = lambda c: F.sum(F.col(c).cast("long"))
    placed = table(placed, "codes")
    turns = placed.groupBy("c", "turn").agg(one("blank").alias("blank"), one("copy").alias("duplicate"), one("cut").alias("truncated"))
    found = turns.groupBy("c").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))
    block = placed.groupBy("c", F.floor(F.col("at") / BLOCK).alias("b")) \
        .agg(F.sort_array(F.collect_list(F.struct("at", "code"))).alias("l"))        # BLOCK rows at most
    block = table(block.select("c", "b", F.transform("l", lambda x: x["code"]).alias("codes")), "blocks")
    costs = table(_block_costs(block), "costs")
    ways = _block_audits(block.join(_behind(costs), ["c", "b"]).select("c", "b", "codes", "close", "end"))
    edits = table(_strung(ways.join(costs.drop("m"), ["c", "b"])), "edits")
    out = found.join(edits, "c").join(_hashes(rows, edits), "c")
    keys = (df if everyone is None else everyone).select(F.col(key).alias("id")).distinct().withColumn("c", _key(F.col("id")))
    none = hashlib.sha256().hexdigest()
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return keys.join(out, "c", "left").select(
        F.col("id").alias(key), *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"))


def damage(df: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``df`` with faults by crc32 of ``key:turn`` (a null is one space) modulo 20: 0 drops a row,
    1 empties its text, 2 takes out its sentence ends, 3 repeats it, 4 makes it the user's."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space(key), F.lit(":"), space(turn))) % 20
    hurt = df.select(F.col(key).alias("_k"), F.col(turn).alias("_n"), kind.alias("_f"), space(role).alias("_r"), space(text).alias("_t")).where("_f <> 0")
    return hurt.select(
        F.col("_k").alias(key), F.col("_n").alias(turn), F.when(F.col("_f") == 4, "user").otherwise(F.col("_r")).alias(role),
        F.when(F.col("_f") == 1, "").when(F.col("_f") == 2, F.translate("_t", ENDS, "")).otherwise(F.col("_t")).alias(text),
        F.explode(F.sequence(F.lit(1), F.when(F.col("_f") == 3, 2).otherwise(1))).alias("_copy")).drop("_copy")
