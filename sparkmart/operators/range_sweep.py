"""Range join by a sweep: how many bands hold each value, and the least of them.

``operators.range_left_join`` emits every hit, so its rows grow with values
times bands where bands are wide.  Here nothing is emitted per hit:

* Distinct values and band ends are range-partitioned together and sorted.  The
  number of values, opened and closed bands before an event is a running count in
  its partition plus the counts of the partitions before (one row each).  So a
  value's bands are counted, and a band becomes a range of value ranks.
* The least band is found on ranks: a range is cut into at most two nodes of each
  power of two (a band that holds everything is one node), each node keeps its
  least band by a partial aggregate, and values look at the nodes above them,
  ``STEP`` levels at a time, from the top down.

Every row count follows the input: one event a value, two a band, up to 2 log n
nodes a band.  Equal band ends are told apart by the band's row number, so no key
or partition has to hold many bands that start or end together.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.sinks.files import write_parquet

#: levels that a value looks up at a time
STEP = 6
#: order of events at one place: a band opens before a value there, and closes after it
OPEN, VALUE, CLOSE = 0, 1, 2
_ROW = (1 << 33) - 1


def _written(df: DataFrame, name: str) -> DataFrame:
    return df.sparkSession.read.parquet(write_parquet(df, df.sparkSession, name))


def _swept(events: DataFrame) -> DataFrame:
    """``events`` (x, kind, band, id) with the number of values, opened and closed bands up to each."""
    order = ["x", "kind", "band"]
    rows = events.repartitionByRange(*order).sortWithinPartitions(*order) \
        .withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW)))
    rows = _written(rows, "events")
    inside = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    names = {"values": VALUE, "opened": OPEN, "closed": CLOSE}
    is_ = lambda kind: F.when(F.col("kind") == kind, 1).otherwise(0)
    part = rows.groupBy("part").agg(*(F.sum(is_(k)).alias(n) for n, k in names.items()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)      # one row a partition
    part = part.select("part", *(F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_{n}") for n in names))
    rows = rows.select("x", "kind", "band", "id", "part", *(F.sum(is_(k)).over(inside).alias(n) for n, k in names.items()))
    return rows.join(F.broadcast(part), "part").select("x", "kind", "band", "id", *((F.col(n) + F.col(f"_{n}")).alias(n) for n in names))


def covering(ranges: DataFrame, n: int, pick=F.min) -> DataFrame:
    """(r, id): of the ``ranges`` (a, z, id) with a <= r < z the ``pick`` of ids, for ranks r below n
    that some range covers."""
    spark, levels = ranges.sparkSession, max(1, n.bit_length())
    left = lambda lv: F.shiftright(F.col("a") + F.shiftleft(F.lit(1).cast("long"), lv) - 1, lv)
    right = lambda lv: F.shiftright(F.col("z"), lv)

    def at_level(lv: int) -> Column:
        a, z = left(lv), right(lv)
        node = lambda c, odd: F.when((a < z) & (odd % 2 == 1), F.struct(F.lit(lv).alias("level"), c.alias("node")))
        return F.array(node(a, a), node(z - 1, z))

    every = F.filter(F.flatten(F.array(*(at_level(lv) for lv in range(levels + 1)))), lambda x: x.isNotNull())
    nodes = ranges.where("a < z").select("id", F.explode(every).alias("n")).groupBy("n.level", "n.node").agg(pick("id").alias("id"))
    nodes = _written(nodes, "nodes")
    above = None
    for base in range(levels // STEP * STEP, -1, -STEP):
        units = spark.range(((n - 1) >> base) + 1).select(F.col("id").alias("u"))
        seen = units.select("u", F.explode(F.sequence(F.lit(0), F.lit(STEP - 1))).alias("k"))
        seen = seen.select("u", (F.col("k") + base).alias("level"), F.expr("shiftright(u, k)").alias("node"))
        found = seen.join(nodes, ["level", "node"]).select("u", "id")
        if above is not None:
            found = found.unionByName(units.withColumn("up", F.shiftright("u", STEP)).join(above, "up").select("u", "id"))
        got = found.groupBy("u").agg(pick("id").alias("id"))
        above = got.withColumnRenamed("u", "up")
    return got.withColumnRenamed("u", "r")


def range_summary(left: DataFrame, value_col: str, bands: DataFrame, lo_col: str, hi_col: str, id_col: str) -> DataFrame:
    """(``value_col``, bands, first_band) of each distinct value of ``left``: how many ``bands`` have
    lo <= value <= hi, and the least ``id_col`` among them (NULL if none).  Bands without an end, or
    that end before they start, hold nothing; a NULL value has no row."""
    kind = "double" if left.schema[value_col].dataType.typeName() in ("double", "float") else "decimal(38,10)"
    values = left.select(F.col(value_col).cast(kind).alias("x")).where("x IS NOT NULL").distinct()
    real = bands.select(F.col(lo_col).cast(kind).alias("lo"), F.col(hi_col).cast(kind).alias("hi"), F.col(id_col).alias("id")) \
        .where("lo <= hi").withColumn("band", F.monotonically_increasing_id())
    ends = real.select("band", "id", F.explode(F.array(F.struct(F.col("lo").alias("x"), F.lit(OPEN).alias("kind")),
                                                       F.struct(F.col("hi").alias("x"), F.lit(CLOSE).alias("kind")))).alias("e")) \
        .select("e.x", "e.kind", "band", "id")
    nothing = F.lit(None).cast(bands.schema[id_col].dataType)
    events = ends.unionByName(values.select("x", F.lit(VALUE).alias("kind"), F.lit(-1).cast("long").alias("band"), nothing.alias("id")))
    swept = _written(_swept(events), "swept")
    counted = swept.where(F.col("kind") == VALUE).select("x", (F.col("values") - 1).alias("r"), (F.col("opened") - F.col("closed")).alias("bands"))
    n = counted.agg(F.count(F.lit(1))).first()[0]
    if n == 0:
        return counted.select(F.col("x").alias(value_col), "bands", nothing.alias("first_band"))
    ranges = swept.where(F.col("kind") != VALUE).groupBy("band").agg(
        F.min("values").alias("a"), F.max("values").alias("z"), F.first("id").alias("id"))
    least = covering(ranges, n).withColumnRenamed("id", "first_band")
    return counted.join(least, "r", "left").select(F.col("x").cast(left.schema[value_col].dataType).alias(value_col), "bands", "first_band")
