"""Key to partition, the way the keyed producer's client assigns it.

The producer uses the librdkafka client, whose default partitioner hashes the
key with CRC32 and takes it modulo the partition count.  ``crc32`` is a
built-in, so this stays inside generated JVM code.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_partition(key, partitions: int) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.crc32(k.cast("binary")), F.lit(partitions)).cast("int")
