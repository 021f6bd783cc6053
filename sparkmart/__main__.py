"""Run a whole job: ``python -m sparkmart <job> ...`` or
``spark-submit --py-files <repo>.zip sparkmart/__main__.py <job> ...``.

Jobs:
  batch-fact     --orders CSV --items CSV --out DIR
  analytics      --tables DIR --query NAME [--out DIR]   (Parquet tables named as in the queries)
  load           --source DIR --target DIR --out DIR [--as-of YYYY-MM-DD]
  models         --payment PARQUET --customer PARQUET --out DIR [--high N --medium N]
                 [--schema YAML]
  transactions   --servers HOST:PORT --checkpoint DIR --report DIR   (needs the Kafka package)
  activity       --servers HOST:PORT --checkpoint DIR --counts DIR   (needs the Kafka package)

The session comes from ``getOrCreate`` so cluster settings of spark-submit
apply; ``--local`` builds a local session instead.
"""
from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

if __package__ in (None, ""):  # run as a script: make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


# query -> the Parquet tables it reads, in argument order
ANALYTICS = {
    "grade_report": ("students", "grades"),
    "extent_distance": ("station",),
    "top_competitors": ("submissions", "hackers", "challenges", "difficulty"),
    "cheapest_per_group": ("wands", "wands_property"),
    "contest_leaderboard": ("submissions", "hackers"),
}


def _session(local: bool) -> SparkSession:
    if local:
        from sparkmart.session import build_session
        return build_session()
    return SparkSession.builder.appName("sparkmart").getOrCreate()


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="sparkmart")
    p.add_argument("--local", action="store_true")
    sub = p.add_subparsers(dest="job", required=True)
    b = sub.add_parser("batch-fact")
    b.add_argument("--orders", required=True)
    b.add_argument("--items", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--key-type", default="int")
    q = sub.add_parser("analytics")
    q.add_argument("--tables", required=True)
    q.add_argument("--query", required=True, choices=sorted(ANALYTICS))
    q.add_argument("--out")
    ld = sub.add_parser("load")
    ld.add_argument("--source", required=True)
    ld.add_argument("--target", required=True)
    ld.add_argument("--out", required=True)
    ld.add_argument("--as-of")
    m = sub.add_parser("models")
    m.add_argument("--payment", required=True)
    m.add_argument("--customer", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--high", type=float, default=100)
    m.add_argument("--medium", type=float, default=50)
    m.add_argument("--schema", help="schema file with the column tests (YAML)")
    t = sub.add_parser("transactions")
    t.add_argument("--servers", required=True)
    t.add_argument("--checkpoint", required=True)
    t.add_argument("--report", required=True)
    t.add_argument("--restarts", type=int, default=0, help="failures after which all three queries go on from their checkpoints")
    a = sub.add_parser("activity")
    a.add_argument("--servers", required=True)
    a.add_argument("--checkpoint", required=True)
    a.add_argument("--counts", required=True)
    args = p.parse_args(argv)
    spark = _session(args.local)

    if args.job == "batch-fact":
        from sparkmart.plans import batch_fact
        back, counts = batch_fact.run(spark, args.orders, args.items, args.out, args.key_type)
        print(json.dumps(counts))
        batch_fact.preview(back).show(truncate=False)
    elif args.job == "analytics":
        from sparkmart.plans import analytics
        inputs = [spark.read.parquet(f"{args.tables}/{t}") for t in ANALYTICS[args.query]]
        result = getattr(analytics, args.query)(*inputs)
        if args.out:
            result.write.mode("overwrite").parquet(args.out)
        else:
            result.show(50, truncate=False)
    elif args.job == "load":
        from sparkmart.plans import etl
        from sparkmart.sinks.files import commit_version, read_current, write_version
        import datetime as dt
        src = {t: spark.read.parquet(f"{args.source}/{t}")
               for t in ("customers", "products", "suppliers", "orders")}
        targets = {t: read_current(spark, args.target, t)
                   for t in ("dim_customers", "dim_products", "fact_orders")}
        as_of = dt.date.fromisoformat(args.as_of) if args.as_of else None
        merged = etl.incremental_load(src["customers"], src["products"], src["suppliers"],
                                      src["orders"], targets, as_of)
        version = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        paths = {t: write_version(df, f"{args.out}/{t}", version) for t, df in merged.items()}
        commit_version(spark, args.out, version)  # last: the three tables change together
        print(json.dumps(paths))
    elif args.job == "models":
        from sparkmart.plans import models
        mart, checks = models.build(spark, spark.read.parquet(args.payment),
                                    spark.read.parquet(args.customer), args.out,
                                    args.high, args.medium)
        if args.schema:
            from sparkmart.operators.quality import checks_from_spec, load_spec
            layers = {n: spark.table(n) for n in
                      ("stg_payment", "int_customer_payment", "mart_customer_revenue")}
            checks = checks_from_spec(layers, load_spec(args.schema))
        checks.show(truncate=False)
        failed = checks.filter("failures > 0").count()
        return 1 if failed else 0
    elif args.job == "transactions":
        from sparkmart.streaming import apps
        from sparkmart.streaming.supervisor import run_with_restarts
        starters = apps.transaction_starters(spark, args.servers, args.checkpoint, args.report)
        run_with_restarts(starters, args.restarts, until_any=True)   # as the original: one ends, all end
    elif args.job == "activity":
        from sparkmart.streaming import apps
        apps.activity_app(spark, args.servers, args.checkpoint, args.counts).awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
