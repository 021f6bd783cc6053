"""Derive a k-times copy of the driver tables for scaling checks (not a registered query).

  python scripts/scale_copy.py SRC_DIR OUT_DIR K [FILES] [--hot]

Each table is repeated K times with its keys shifted by copy * (max key + 1),
foreign keys shifted with the key they reference, so every join still finds
its partner; copies come from ``explode(sequence(0, K-1))``.  Tables are
written as FILES Parquet files each (default 16), so scans split across
cores.  ``--hot`` then gives a third of the rows of events, orders and lineitem
the same user, customer and part (one key holding a third of all rows).
Then: ``BENCH_SF_DIR=OUT_DIR python bench.py`` or
``python tests/run_oracles.py OUT_DIR``.
"""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from sparkmart.session import build_session  # noqa: E402

# column -> (table, key) whose range sets the shift
SHIFTS = {
    "orders": {"o_orderkey": ("orders", "o_orderkey"), "o_custkey": ("customer", "c_custkey")},
    "lineitem": {"l_orderkey": ("orders", "o_orderkey"), "l_partkey": ("part", "p_partkey"),
                 "l_suppkey": ("supplier", "s_suppkey")},
    "customer": {"c_custkey": ("customer", "c_custkey")},
    "part": {"p_partkey": ("part", "p_partkey")},
    "supplier": {"s_suppkey": ("supplier", "s_suppkey")},
    "events": {"event_id": ("events", "event_id"), "user_id": ("events", "user_id")},
}
UNCHANGED = ("region", "nation")
# --hot: (column made hot, column whose value picks one row in three)
HOT = {"events": ("user_id", "event_id"), "orders": ("o_custkey", "o_orderkey"),
       "lineitem": ("l_partkey", "l_orderkey")}


def main() -> None:
    hot = "--hot" in sys.argv
    args = [a for a in sys.argv[1:] if a != "--hot"]
    src, out, k = args[0], args[1], int(args[2])
    files = int(args[3]) if len(args) > 3 else 16
    spark = build_session()
    read = lambda t: spark.read.parquet(f"{src}/{t}.parquet")
    span = {}
    for shifts in SHIFTS.values():
        for t, key in shifts.values():
            if (t, key) not in span:
                span[(t, key)] = read(t).agg(F.max(key)).first()[0] + 1
    for t, shifts in SHIFTS.items():
        df = read(t).withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
        cols = [(F.col(f.name) + F.col("__copy") * F.lit(span[shifts[f.name]])).cast(f.dataType)
                .alias(f.name) if f.name in shifts else F.col(f.name)
                for f in read(t).schema.fields]
        df = df.select(*cols)
        if hot and t in HOT:
            col, by = HOT[t]
            df = df.withColumn(col, F.when(F.col(by) % 3 == 0, F.lit(0).cast(df.schema[col].dataType))
                               .otherwise(F.col(col)))
        df.repartition(files).write.mode("overwrite").parquet(f"{out}/{t}.parquet")
    for t in UNCHANGED:
        read(t).write.mode("overwrite").parquet(f"{out}/{t}.parquet")
    spark.stop()


if __name__ == "__main__":
    main()
