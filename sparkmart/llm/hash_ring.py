"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has a fixed number of slots.  Every shard owns ``vnodes`` virtual
nodes at hashed slots; a row's key hashes to a slot and belongs to the next
virtual node clockwise.  A shard takes rows up to its capacity; what
overflows continues clockwise to the next virtual node whose shard has room.

Only row counts per ring slot (a table bounded by ``slots``) reach the driver,
which works out how many rows of which arc go where.  The rows themselves are
range-sorted by ring position once, and each one reads its shard and its slot
in the shard off its position: no window over a shard, no Python on the rows,
and a hot key only fills more of the sorted range.

With ``slack`` 0 the capacities are the row count divided by the shards, the
remainder going one each to the first shards: counts differ by one at most.  With a
positive slack each shard takes up to (1 + slack) times its share and fewer
rows move when a shard is added.

Defined cases: a null key hashes like a value of its own (its rows sit at one
slot and overflow clockwise); a null text has size ``overhead`` and CRC 0; a very long
text is measured where it is read and does not travel; rows of one key stand in the order of
their sorted columns, equal ones in any; repeated rows each get a slot; an empty table gives an empty result; columns
of the input other than the key and the text do not matter.
"""
from __future__ import annotations

from bisect import bisect_left
from collections import deque
from collections.abc import Sequence
from hashlib import blake2b

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import literal_table, positioned

SLOTS = 1 << 16


def ring(shards: int, vnodes: int, slots: int = SLOTS) -> list[tuple[int, int]]:
    """The virtual nodes as (slot, shard) in clockwise order.  A node's place
    depends on its shard and number alone."""
    at = [(int.from_bytes(blake2b(f"{s}/{v}".encode(), digest_size=8).digest(), "big") % slots, s)
          for s in range(shards) for v in range(vnodes)]
    return sorted(at)


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    if slack > 0:
        return [-(-int(rows * (1 + slack) + 0.999999) // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def flow(counts: Sequence[int], owners: Sequence[int], room: list[int]) -> list[tuple[int, int, int, int]]:
    """(arc, from, to, shard): which of an arc's rows, by rank, go to which shard.

    Every arc first fills its own shard; then what is left travels clockwise,
    first come first served.  ``room`` must hold all rows."""
    out, waiting, left = [], deque(), []
    for a, n in enumerate(counts):
        take = min(n, room[owners[a]])
        room[owners[a]] -= take
        if take:
            out.append((a, 0, take, owners[a]))
        left.append((take, n))
    for lap in range(2):
        for a, (lo, hi) in enumerate(left):
            if lap == 0 and lo < hi:
                waiting.append((a, lo, hi))
            s = owners[a]
            while waiting and room[s]:
                arc, lo2, hi2 = waiting.popleft()
                take = min(hi2 - lo2, room[s])
                room[s] -= take
                out.append((arc, lo2, lo2 + take, s))
                if lo2 + take < hi2:
                    waiting.appendleft((arc, lo2 + take, hi2))
    return sorted(out)


def shard_rows(df: DataFrame, shards: int, *, key: str = "doc_id", text: str = "text", vnodes: int = 128,
               slack: float = 0.0, overhead: int = 16, slots: int = SLOTS) -> DataFrame:
    """One row per row of ``df``: the key, ``size`` (UTF-8 bytes plus
    ``overhead``), ``text_crc32``, ``shard``, ``slot`` (gapless in its shard)
    and ``home`` (the shard before any overflow)."""
    spark = df.sparkSession
    nodes = ring(shards, vnodes, slots)
    # turned so that the arc of the first node starts at 0 and no arc wraps
    turn = (nodes[-1][0] + 1) % slots
    ends = sorted(((p - turn) % slots, s) for p, s in nodes)
    positions, owners = [p for p, _ in ends], [s for _, s in ends]
    raw = F.encode(F.col(text), "utf-8")
    rows = df.select(
        F.col(key).alias("_key"),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + F.lit(overhead)).alias("_size"),
        F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("_crc"),
        F.xxhash64(F.col(key)).alias("_h"))
    rows = rows.withColumn("_at", F.pmod(F.pmod(F.col("_h"), F.lit(slots)) - F.lit(turn), F.lit(slots)).cast("int")) \
        .withColumn("_tie", F.monotonically_increasing_id())
    pos = positioned(rows, ["_at", "_h", "_crc", "_size", "_tie"], "ring")
    per_slot = {r[0]: r[1] for r in pos.groupBy("_at").count().collect()}  # at most `slots` numbers
    counts, slot_arc = [0] * len(ends), {}
    for at, n in per_slot.items():
        slot_arc[at] = arc = bisect_left(positions, at)
        counts[arc] += n
    arc_start, total = [], 0
    for n in counts:
        arc_start.append(total)
        total += n
    plan, used = [], [0] * shards
    by_arc: dict[int, list] = {}
    for arc, lo, hi, s in flow(counts, owners, capacities(total, shards, slack)):
        by_arc.setdefault(arc, []).append((arc_start[arc] + lo, arc_start[arc] + hi, s, used[s]))
        used[s] += hi - lo
    start = 0
    for at in sorted(per_slot):
        end, arc = start + per_slot[at], slot_arc[at]
        plan += [{"_at": at, "_lo": max(lo, start), "_hi": min(hi, end), "shard": s, "_home": owners[arc],
                  "_base": base - lo} for lo, hi, s, base in by_arc[arc] if lo < end and hi > start]
        start = end
    # at most slots + shards * vnodes + overflow pieces rows: bounded by parameters
    pieces = literal_table(spark, plan, "_at int, _lo long, _hi long, shard int, _home int, _base long")
    got = pos.join(F.broadcast(pieces), (pos["_at"] == pieces["_at"]) & (F.col("_gi") >= F.col("_lo"))
                   & (F.col("_gi") < F.col("_hi")))
    return got.select(F.col("_key").alias(key), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
                      "shard", (F.col("_base") + F.col("_gi")).alias("slot"), F.col("_home").alias("home"))
