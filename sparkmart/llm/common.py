"""What several operators share: written intermediate tables, positions in a
global order, text batches for numpy, and rolling hashes.

All intermediate tables go to the shared folder in ``spark.checkpoint.dir``
(see ``sparkmart.session.scratch_dir``), so a lost executor costs at most the
step since the last written table.
"""
from __future__ import annotations

import json
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.session import scratch_dir

#: bytes of text that a task turns into numpy arrays at a time (memory bound per worker)
CHUNK_BYTES = 1 << 20


_SHIPPED: dict[str, str] = {}


#: rows of an Arrow batch: texts travel whole, and both sides hold a batch of them
ARROW_ROWS = 1500
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """The package's source to the executors' Python, once per application, and Arrow
    batches that are small enough for texts (a session that asks for smaller ones keeps its own).
    Spark's own file distribution carries the zip; workers need no shared path."""
    sc = spark.sparkContext
    if not 0 < int(spark.conf.get(_BATCH, "10000")) <= ARROW_ROWS:
        spark.conf.set(_BATCH, str(ARROW_ROWS))
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="sparkmart-src-")) / "sparkmart_src.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(path))
    _SHIPPED[sc.applicationId] = str(path)


def table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm_{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: rows of a few numbers each that are broadcast at most
BROADCAST_ROWS = 2_000_000


def small(df: DataFrame) -> DataFrame:
    """``df``, of narrow rows, marked for broadcast if its counted rows are few enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def literal_table(spark: SparkSession, rows: Sequence[dict], schema: str) -> DataFrame:
    """A small table from the driver as one JSON literal: no RDD, no Arrow.
    For tables bounded by parameters only."""
    text = json.dumps(list(rows))
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{schema}>>")))


def positioned(df: DataFrame, order: Sequence[str], name: str, index: str = "_gi") -> DataFrame:
    """``df`` with its 0-based position in ``order``, without a single-task window.

    One range exchange sorts the rows; each partition numbers its own, and the
    partitions' row counts (one number per partition, from the written table)
    become their starting points.  ``order`` should end in something unique:
    equal keys stay in one partition.
    """
    spark = df.sparkSession
    s = (df.repartitionByRange(*order).sortWithinPartitions(*order)
         .withColumn("_part", F.spark_partition_id())
         .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    t = table(s, name)
    start, rows = 0, []
    for r in sorted(t.groupBy("_part").count().collect()):
        rows.append({"_part": r[0], "_start": start})
        start += r[1]
    starts = literal_table(spark, rows, "_part int, _start long")
    return (t.join(F.broadcast(starts), "_part")  # one row per partition
            .withColumn(index, F.col("_start") + F.col("_row")).drop("_part", "_row", "_start"))


def as_bytes(text: str | None) -> bytes:
    """UTF-8 of a text; none for null."""
    return b"" if text is None else text.encode("utf-8")


def slices(sizes: Sequence[int], most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive [from, to) of rows whose sizes add up to about ``most`` at most
    (a single larger row stands alone)."""
    lo = total = 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > most:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def tidy(run: Callable) -> Callable:
    """``run``, for mapInArrow, whose worker gives its memory back at the end: idle
    workers wait for later stages and would hold what they once needed."""
    def lean(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return lean


def release() -> None:
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)    # glibc only
    if trim is not None:
        trim(0)


def clean(spark: SparkSession) -> None:
    """Lets Spark drop what is out of use.  Its cleaner removes broadcasts and shuffles from the
    executors when the driver's JVM finds them unreferenced, which an idle driver does every half
    hour only; until then they fill the executors' memory and disks."""
    import gc
    gc.collect()
    jvm = getattr(spark, "_jvm", None)      # none in a Connect session
    if jvm is not None:
        jvm.java.lang.System.gc()


# ---------------------------------------------------------------- hashing

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64's), elementwise; in place on a copy."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers."""
    r = np.random.Generator(np.random.PCG64(seed))
    return r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True          # fixed: \x20 and \x09-\x0D part words
_BYTE = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
_FOLD = _BYTE.copy()
_FOLD[65:91] = _BYTE[97:123]                    # A-Z hash like a-z

# Two polynomials modulo the prime 2**31 - 1: unlike one modulo 2**64, they have no texts that
# collide for every base (Thue-Morse words), and products of two residues fit 64 bits.
_PRIME = (1 << 31) - 1
_BASES = (1_566_083_941, 822_752_021)
#: bytes of a word hashed at a time; bounds the tables of powers too
HASH_BYTES = 1 << 17
_POWERS: list[np.ndarray] = []


def _folded(x: np.ndarray) -> np.ndarray:
    return (x & np.uint64(_PRIME)) + (x >> np.uint64(31))


def _residue(x: np.ndarray) -> np.ndarray:
    x = _folded(_folded(x))
    return np.minimum(x, x - np.uint64(_PRIME))    # below the prime it wraps to something huge


def powers(n: int) -> list[np.ndarray]:
    """Powers 0..n-1 of each base and of its inverse (32 bits each)."""
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS.clear()
        for base in (x for b in _BASES for x in (b, pow(b, -1, _PRIME))):
            p, k = np.ones(n, np.uint64), 1
            while k < n:
                m = min(k, n - k)
                p[k:k + m] = _residue(p[:m] * np.uint64(pow(base, k, _PRIME)))
                k += m
            _POWERS.append(p.astype(np.uint32))
    return [p[:n] for p in _POWERS]


def _span_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """The two polynomials over values[start:end] for each span."""
    up1, down1, up2, down2 = powers(len(values) + 1)
    out = []
    for v, up, down in ((values >> np.uint64(33), up1, down1), (values & np.uint64(_PRIME), up2, down2)):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_folded(v * up[:-1]), dtype=np.uint64)))
        out.append(_residue(_residue(total[ends] - total[starts]) * down[starts]))
    return out


def _joined(one: np.ndarray, two: np.ndarray, size: np.ndarray) -> np.ndarray:
    return mix(((one << np.uint64(31)) | two) + size.astype(np.uint64) * _M2)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash (62 bits, mixed to 64) of values[start:end] for each span: equal content, equal hash,
    wherever it stands."""
    return _joined(*_span_sums(values, starts, ends), ends - starts)


def _long_hash(kind: np.ndarray, data: np.ndarray) -> np.ndarray:
    """``span_hashes`` of all of ``data``, piece by piece."""
    total, none = [0, 0], np.zeros(1, np.int64)
    for lo in range(0, len(data), HASH_BYTES):
        part = kind[data[lo:lo + HASH_BYTES]]
        for j, s in enumerate(_span_sums(part, none, none + len(part))):
            total[j] = (total[j] + int(s[0]) * pow(_BASES[j], lo, _PRIME)) % _PRIME
    return _joined(*(np.array([t], np.uint64) for t in total), np.array([len(data)]))


def word_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` in bytes."""
    gap = np.ones(len(raw) + 2, np.int8)
    gap[1:-1] = _SPACE[np.frombuffer(raw, np.uint8)]
    step = np.diff(gap)
    return np.flatnonzero(step == -1), np.flatnonzero(step == 1)


def word_hashes(raw: bytes, fold: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of each word; ``fold``: A-Z count as a-z."""
    starts, ends = word_spans(raw)
    if not len(starts):
        return np.empty(0, np.uint64), starts, ends
    kind, data, parts = _FOLD if fold else _BYTE, np.frombuffer(raw, np.uint8), []
    for lo, hi in slices(ends - starts + 1, HASH_BYTES):      # bounded arrays for very long texts
        a, b = starts[lo], ends[hi - 1]
        if b - a > HASH_BYTES:
            parts.append(_long_hash(kind, data[a:b]))         # one word
        else:
            parts.append(span_hashes(kind[data[a:b]], starts[lo:hi] - a, ends[lo:hi] - a))
    return np.concatenate(parts), starts, ends


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n`` consecutive elements of ``h`` (length len(h) - n + 1)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for j, a in enumerate(seeds(n, 7)):
        out += mix(h[j:j + m] * a) if j == 0 else h[j:j + m] * a
    return mix(out)


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal neighbours."""
    if not len(values):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return at, np.diff(np.append(at, len(values)))


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` consecutive elements (length len(h) - w + 1), by doubling."""
    n = len(h) - w + 1
    if n <= 0:
        return h[:0]
    k, cur = 1, h
    while 2 * k <= w:
        cur = np.minimum(cur[:-k], cur[k:])
        k *= 2
    return np.minimum(cur[:n], cur[w - k:w - k + n])
