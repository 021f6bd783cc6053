"""Bulk-synchronous best-fit packing of tokenised documents into sequences.

Tokenisation runs once, next to the scan, and leaves one small row per piece
(no text, no ids).  A length is a whole number up to the capacity, so the
range-sorted pieces fall into at most ``capacity`` runs of equal length, and
gaps into as many.  A step takes the longest run left; its successor sweep
finds the smallest gaps that hold it, ranks within the run decide which piece
gets which gap, the gaps shrink, and the next run follows.  The steps need
only the number of pieces of each length, a table bounded by the capacity.
Their outcome, again a bounded table of (length, ranks -> sequences), meets
the pieces in one distributed join on the length, on ranks that a range sort
gave.  The result is that of best-fit decreasing over all documents.

Defined cases: a null text is empty; an empty document is the closing id
alone; a very long text is tokenised whole by one task and cut into pieces; pieces of one
length are ranked by their CRC, then their other columns, and equal ones in any order; null keys and repeated rows pack like others; an empty table gives an
empty result; other columns are not read.
"""
from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.llm.common import CHUNK_BYTES, literal_table, positioned, slices, table, tidy

#: chunk -> ids cached per Python worker (about 50 MB when full; emptied then)
CACHE_ENTRIES = 400_000
#: chunks longer than this are encoded anew each time
CACHE_CHUNK = 64


#: words whose ids are those of the lower-cased word alone: letters that are
#: their own composed form, with one closing mark at most
PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,]?)")


def as_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class ChunkEncoder:
    """Ids of a text as little-endian 32-bit bytes.

    The tokenizer drops white space and never joins across it, so a text's
    ids are those of its white-space separated chunks one after another, and
    a chunk's ids can be remembered.  A chunk of plain letters skips the
    tokenizer's normaliser and splitter, which would only lower-case it and
    part the closing mark; all others go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tok = Tokenizer.from_file(path)
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelled = {c: "".join(p for p, _ in level.pre_tokenize_str(chr(c))) for c in range(0xC0, 0x100)}
        self.known: dict[bytes, bytes] = {}
        # fixed by the vocabulary file: is it of the kind that PLAIN speaks of?
        self.fast = all(self._whole(w) == self._word(w.lower()) for w in ("The", "Écoutönß", "zx"))
        self.marks = {m: self._whole(m) for m in (".", ",")}

    def _whole(self, text: str) -> bytes:
        return as_ids(self.tok.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        if not word.isascii():
            word = word.translate(self.spelled)
        return as_ids([t.id for t in self.tok.model.tokenize(word)])

    def get(self, chunk: bytes) -> bytes:
        known = self.known
        got = known.get(chunk)
        if got is not None:
            return got
        text = chunk.decode("utf-8")
        m = PLAIN.fullmatch(text) if self.fast else None
        if m is None:
            got = self._whole(text)
        else:
            word = m[1].lower()
            key = word.encode("utf-8")
            got = known.get(key)
            if got is None:
                got = self._word(word)
                if len(key) <= CACHE_CHUNK:
                    known[key] = got
            if m[2]:
                got = got + self.marks[m[2]]
        if len(chunk) <= CACHE_CHUNK:
            known[chunk] = got
        return got

    def __call__(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the ids of an Arrow array of texts one after another,
        and where each text's end.  Each distinct chunk is looked up once."""
        import pyarrow.compute as pc
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = words.flatten().dictionary_encode()
        parts = [self.get(w.encode("utf-8")) for w in coded.dictionary.to_pylist()]
        stock = np.frombuffer(b"".join(parts), "<u4")
        count = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        first = np.cumsum(count) - count
        at = coded.indices.to_numpy()
        n = count[at]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        ids = stock[np.repeat(first[at] - (ends - n), n) + np.arange(total)]
        offsets = words.offsets.to_numpy() - words.offsets[0].as_py()
        return ids, np.concatenate(([0], ends))[offsets[1:]]


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One encoder per worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def token_pieces(df: DataFrame, tokenizer: str, capacity: int = 2048, *, key: str = "doc_id",
                 text: str = "text", end_id: int = 0) -> DataFrame:
    """A row per piece: key, piece, start, length, ids_crc32.  A document is
    its ids and ``end_id``; only one longer than ``capacity`` is cut."""
    kind = df.schema[key].dataType
    out = T.StructType([T.StructField(key, kind), T.StructField("piece", T.IntegerType()),
                        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                        T.StructField("ids_crc32", T.LongType())])
    end = as_ids([end_id])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        enc = encoder(tokenizer)
        for b in batches:
            at, piece, start, length, crc = [], [], [], [], []
            sizes = pc.fill_null(pc.binary_length(b.column(1)), 0).to_pylist()
            for first, last in slices(sizes, 4 * CHUNK_BYTES):
                all_ids, ends = enc(b.column(1).slice(first, last - first))
                for i, (lo, hi) in enumerate(zip([0, *ends[:-1]], ends), first):
                    ids = all_ids[lo:hi].tobytes() + end
                    for p, lo in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[lo:lo + 4 * capacity]
                        at.append(i)
                        piece.append(p)
                        start.append(lo // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=[key, "piece", "start", "length", "ids_crc32"])

    return df.select(F.col(key), F.col(text).cast("string").alias(text)).mapInArrow(tidy(run), out)


def best_fit_steps(counts: dict[int, int], capacity: int) -> list[dict]:
    """Best-fit decreasing over runs of equal lengths.

    Returns runs: pieces of ``length`` with rank lo..hi-1 in their length go,
    ``each`` to a sequence, to sequences base, base+1, ... from ``place`` on.
    """
    gaps: dict[int, list] = {}      # free room -> [(first sequence, sequences)]
    sizes: list[int] = []           # the keys of gaps, sorted
    out, opened = [], 0

    def put(room: int, base: int, n: int) -> None:
        if room and n:
            if room not in gaps:
                gaps[room] = []
                insort(sizes, room)
            gaps[room].append((base, n))

    for size in sorted((s for s in counts if counts[s]), reverse=True):
        rank, left = 0, counts[size]
        while left:
            at = bisect_left(sizes, size)  # successor: the smallest gap that holds it
            if at < len(sizes):
                room = sizes[at]
                base, n = gaps[room].pop()
                if not gaps[room]:
                    del gaps[room], sizes[at]
            else:
                room, base = capacity, opened
                n = -(-left // (capacity // size))
                opened += n
            each = room // size
            full = min(n, left // each)
            if full:
                out.append({"length": size, "lo": rank, "hi": rank + full * each, "each": each,
                            "base": base, "place": capacity - room})
                put(room - each * size, base, full)
                rank, left, base, n = rank + full * each, left - full * each, base + full, n - full
            if n and left:  # fewer than `each` are left for this gap
                out.append({"length": size, "lo": rank, "hi": rank + left, "each": left, "base": base,
                            "place": capacity - room})
                put(room - left * size, base, 1)
                rank, base, n, left = rank + left, base + 1, n - 1, 0
            put(room, base, n)
    return out


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` plus ``sequence_id`` and ``offset`` (place in the sequence)."""
    spark = pieces.sparkSession
    pieces = table(pieces, "pieces")  # a range sort reads its input twice: tokenise once
    order = ["length", "ids_crc32", *[c for c in pieces.columns if c not in ("length", "ids_crc32")], "_tie"]
    rows = positioned(pieces.withColumn("_tie", F.monotonically_increasing_id()), order, "sorted_pieces")
    counts = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}  # at most `capacity` numbers
    first, total = {}, 0
    for size in sorted(counts):
        first[size] = total
        total += counts[size]
    steps = [r | {"lo": r["lo"] + first[r["length"]], "hi": r["hi"] + first[r["length"]]}
             for r in best_fit_steps(counts, capacity)]
    plan = literal_table(spark, steps, "length long, lo long, hi long, each long, base long, place long") \
        .withColumnRenamed("length", "_length")
    # the steps depend on the capacity, not on the number of documents: a bounded broadcast
    got = rows.join(F.broadcast(plan), (rows["length"] == plan["_length"]) & (F.col("_gi") >= F.col("lo"))
                    & (F.col("_gi") < F.col("hi")))
    j = F.col("_gi") - F.col("lo")
    return got.select(*pieces.columns, (F.col("base") + F.floor(j / F.col("each"))).cast("long").alias("sequence_id"),
                      (F.col("place") + j % F.col("each") * F.col("length")).cast("long").alias("offset"))
