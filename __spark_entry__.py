"""

Every registered query reads the driver's whole tables, casts them in the
roles a workload expects (``sparkmart.plans.roles``: renames, retypes,
derived columns and key-based fault injection, never row removal), runs the
workload from ``sparkmart.plans`` / ``sparkmart.streaming`` and returns the
result with engine-neutral types (``_comparable``).  ``oracle_sql`` holds the
same result written as DuckDB SQL over the same tables.  Floating results
that depend on summation order are rounded on both sides.

Sections: batch fact, analytic SQL, layered models, incremental ETL, event
streams (batch and Structured Streaming replays of ``events``), keyed events.
"""
from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.plans import activity, analytics, batch_fact, etl, models, roles, tasks, transactions

SMOKE_DIR = "/root/testdata/sf0.001"


#: buckets of the tables that the queries store, at least
BUCKETS = 8


# ---------------------------------------------------------------- batch fact

def _clean_orders(spark, sf):
    return batch_fact.clean_orders(roles.csv_orders(spark, sf), key_type="bigint")


def _clean_items(spark, sf):
    return batch_fact.clean_order_items(roles.csv_order_items(spark, sf), key_type="bigint")


def q_fact_transactions(spark, sf):
    return batch_fact.build_fact(_clean_orders(spark, sf), _clean_items(spark, sf))


def q_fact_preview(spark, sf):
    return batch_fact.preview(q_fact_transactions(spark, sf), 5)


def q_row_count_audit(spark, sf):
    return batch_fact.audit(_clean_orders(spark, sf), _clean_items(spark, sf))


def q_fact_from_csv(spark, sf):
    """The fact from CSV files, written from the tables and read as text."""
    from sparkmart.session import scratch_dir
    from sparkmart.sources.files import read_csv_strings
    paths = []
    for name, df in (("orders", roles.csv_orders(spark, sf)), ("items", roles.csv_order_items(spark, sf))):
        paths.append(scratch_dir(spark, f"csv_{name}"))
        df.write.option("header", True).csv(paths[-1])
    return batch_fact.build_fact(batch_fact.clean_orders(read_csv_strings(spark, paths[0]), key_type="bigint"),
                                 batch_fact.clean_order_items(read_csv_strings(spark, paths[1]), key_type="bigint"))


def q_csv_bad_lines(spark, sf):
    """Orders from CSV files whose headers differ in order, with lines that are broken by key: the
    cleaned rows, and the broken lines as they stand."""
    from sparkmart.session import scratch_dir
    from sparkmart.sources.files import read_csv_checked
    path = scratch_dir(spark, "csv_mixed")
    key = F.floor(F.col("order_id").cast("double")).cast("long")
    user = F.when(key % 37 == 0, "x,y").when(key % 41 == 0, '"abc').otherwise(F.col("user_id"))
    orders = roles.csv_orders(spark, sf).withColumn("user_id", user)
    for i, columns in enumerate((batch_fact.ORDER_COLUMNS, ("total_amount", "order_date", "user_id", "order_id"))):
        # lines as they stand, so a comma in a cell makes one cell too many, and a quote is never closed
        line = F.concat_ws(",", *(F.coalesce(c, F.lit("")) for c in columns)).alias(",".join(columns))
        orders.where(key % 2 == i).select(line).write.mode("append").option("header", True).option("sep", "\a").option("quote", "").csv(path)
    rows, rejected = read_csv_checked(spark, path, batch_fact.ORDER_COLUMNS)
    return batch_fact.clean_orders(rows, key_type="bigint").unionByName(rejected, allowMissingColumns=True)


def q_fact_bucketed(spark, sf):
    """The fact from tables that are stored in buckets of their join key."""
    return batch_fact.build_fact(*_stored(spark, "order_id", orders=_clean_orders(spark, sf), items=_clean_items(spark, sf)))


def _stored(spark, key, **tables_by_name):
    import uuid
    from sparkmart.session import scratch_dir
    from sparkmart.sinks.tables import bucket_count, write_bucketed
    run, buckets = uuid.uuid4().hex[:12], bucket_count(*tables_by_name.values(), least=BUCKETS)
    return [write_bucketed(df, f"{name}_{run}", [key], buckets, scratch_dir(spark, name)) for name, df in tables_by_name.items()]


def q_fact_roundtrip(spark, sf):
    from sparkmart.sinks.files import write_parquet
    path = write_parquet(q_fact_transactions(spark, sf), spark, "fact_transactions")
    return spark.read.parquet(path)


_ORDERS_SQL = """
  ro AS (
    SELECT CASE WHEN o_orderkey % 71 = 0 THEN o_orderkey || '.0' ELSE CAST(o_orderkey AS VARCHAR) END AS id,
           CASE WHEN o_orderkey % 97 = 0 THEN '-1' WHEN o_orderkey % 89 = 0 THEN 'x'
                WHEN o_orderkey % 79 = 0 THEN o_custkey || '.0' ELSE CAST(o_custkey AS VARCHAR) END AS usr,
           CASE WHEN o_orderkey % 83 = 0 THEN strftime(o_orderdate, '%d/%m/%Y')
                ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
    FROM orders),
  co AS (
    SELECT CAST(TRY_CAST(id AS DECIMAL(38, 6)) AS BIGINT) AS order_id,
           CAST(TRY_CAST(usr AS DECIMAL(38, 6)) AS BIGINT) AS customer_id,
           CAST(try_strptime(day, '%Y-%m-%d') AS DATE) AS order_date
    FROM ro),
  ri AS (
    SELECT l_orderkey, l_partkey, l_extendedprice,
           CASE WHEN l_orderkey % 101 = 0 THEN '0' WHEN l_orderkey % 103 = 0 THEN '2.5'
                WHEN l_orderkey % 107 = 0 THEN 'x' WHEN l_orderkey % 109 = 0 THEN NULL
                WHEN l_orderkey % 113 = 0 THEN '-1' ELSE CAST(l_quantity AS VARCHAR) END AS q
    FROM lineitem),
  ci AS (
    SELECT TRY_CAST(CAST(l_orderkey AS VARCHAR) AS BIGINT) AS order_id,
           TRY_CAST(CAST(l_partkey AS VARCHAR) AS BIGINT) AS product_id,
           CAST(trunc(TRY_CAST(q AS DOUBLE)) AS INTEGER) AS quantity,
           TRY_CAST(CAST(l_extendedprice AS VARCHAR) AS DOUBLE) AS price
    FROM ri WHERE trunc(TRY_CAST(q AS DOUBLE)) > 0),
  fact AS (
    SELECT co.order_id, customer_id, order_date, product_id, quantity, price,
           quantity * price AS gmv
    FROM co JOIN ci ON co.order_id = ci.order_id)
"""



# ------------------------------------------------------------ analytic SQL

def q_grade_report(spark, sf):
    return analytics.grade_report(roles.students(spark, sf), roles.grades(spark))


def q_price_bands(spark, sf):
    """How many part price bands hold each account balance: many narrow bands,
    a few very wide ones and some without an upper end (these hold nothing)."""
    from sparkmart.operators.range_sweep import range_summary
    accounts = roles.accounts(spark, sf)
    held = range_summary(accounts, "total_amount", roles.price_bands(spark, sf), "lo", "hi", "band")
    return accounts.join(held, "total_amount", "left") \
        .select("id", F.coalesce("bands", F.lit(0).cast("long")).alias("bands"), "first_band")


def q_extent_distance(spark, sf):
    return analytics.extent_distance(roles.station(spark, sf))


def q_top_competitors(spark, sf):
    return analytics.top_competitors(roles.ship_submissions(spark, sf),
                                     roles.supplier_hackers(spark, sf),
                                     roles.part_challenges(spark, sf), roles.difficulty(spark))


def q_cheapest_per_group(spark, sf):
    return analytics.cheapest_per_group(roles.wands(spark, sf), roles.wand_properties(spark, sf))


def q_contest_leaderboard(spark, sf):
    r = analytics.contest_leaderboard(roles.order_submissions(spark, sf),
                                      roles.customer_hackers(spark, sf), min_total=1_000_000)
    return r.withColumn("total_score", F.round("total_score", 2))


_GRADES_SQL = """g AS (SELECT CAST(i AS INTEGER) AS grade,
        CAST(i - 1 AS DOUBLE) * CAST(1000.0 AS DOUBLE) AS min_mark,
        CAST(i - 1 AS DOUBLE) * CAST(1000.0 AS DOUBLE) + CAST(999.99 AS DOUBLE) AS max_mark
      FROM range(1, 11) t(i))"""
_FULL_SCORES_SQL = "d(difficulty_level, score) AS (VALUES " + ", ".join(
    f"('{k}', {v})" for k, v in roles.FULL_SCORES) + ")"

# ------------------------------------------------------------ layered models

def _to_double(df, *cols):
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def q_stg_payment(spark, sf):
    return _to_double(models.stg_payment(roles.payment(spark, sf)), "amount", "amount_usd")


def _mart_base(spark, sf):
    stg = models.stg_payment(roles.named_payment(spark, sf))
    return models.int_customer_payment(stg, roles.model_customer(spark, sf))


def q_int_customer_payment(spark, sf):
    return _to_double(_mart_base(spark, sf), "total_amount")


def _mart(spark, sf):
    return models.mart_customer_revenue(_mart_base(spark, sf), high=2_000_000, medium=1_000_000)


def q_mart_customer_revenue(spark, sf):
    return _to_double(_mart(spark, sf), "total_amount")


def q_layered_mart(spark, sf):
    """The layers through a view and tables, the mart read back by its name."""
    from sparkmart.session import scratch_dir
    from sparkmart.sources.files import read_table
    models.build(spark, roles.named_payment(spark, sf), roles.model_customer(spark, sf),
                 scratch_dir(spark, "layers"), high=2_000_000, medium=1_000_000)
    return _to_double(read_table(spark, "mart_customer_revenue"), "total_amount")


def q_mart_bucketed(spark, sf):
    """The mart from payments and customers that are stored in buckets of the customer."""
    payment, customer = _stored(spark, "customer_id", payment=models.stg_payment(roles.named_payment(spark, sf)),
                                customer=roles.model_customer(spark, sf))
    mart = models.mart_customer_revenue(models.int_customer_payment(payment, customer), high=2_000_000, medium=1_000_000)
    return _to_double(mart, "total_amount")


def q_quality_checks(spark, sf):
    from sparkmart.operators.quality import accepted_values, not_null, run_checks, unique
    stg = models.stg_payment(roles.payment(spark, sf))
    lineitem = spark.read.parquet(f"{sf}/lineitem.parquet")
    named = models.stg_payment(roles.named_payment(spark, sf))
    return run_checks(models.model_checks(stg, _mart(spark, sf)),
                      unique(lineitem, ["l_orderkey", "l_linenumber"]),
                      not_null(named, "customer_id"),
                      accepted_values(_mart(spark, sf), models.CATEGORY_COLUMN, ["HIGH"], "accepted_values(HIGH)"))


_PAYMENT_SQL = """pay_all AS (SELECT o_orderkey AS payment_id, o_custkey AS customer_id,
        CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS staff_id, o_orderkey AS rental_id,
        CAST(o_totalprice AS DECIMAL(12,2)) AS amount, o_orderdate AS payment_date,
        o_orderstatus AS status FROM orders),
  stg AS (SELECT payment_id, customer_id, staff_id, rental_id, amount, amount * 1.0 AS amount_usd,
        CAST(payment_date AS DATE) AS payment_date FROM pay_all),
  named AS (SELECT * REPLACE (CASE WHEN customer_id % 7 = 0 THEN NULL ELSE customer_id END AS customer_id) FROM stg),
  base AS (SELECT c.c_custkey AS customer_id, c.c_name AS first_name, c.c_mktsegment AS last_name,
        SUM(p.amount) AS total_amount, COUNT(p.payment_id) AS total_transactions
        FROM customer c LEFT JOIN named p ON c.c_custkey = p.customer_id GROUP BY 1, 2, 3),
  mart AS (SELECT customer_id, upper(first_name || ' ' || last_name) AS nama_lengkap,
        total_amount, total_transactions,
        CASE WHEN total_amount > 2000000 THEN 'HIGH'
             WHEN total_amount BETWEEN 1000000 AND 2000000 THEN 'MEDIUM' ELSE 'LOW' END
        AS kategori_customer FROM base)
"""

# ------------------------------------------------------------ incremental ETL

def _as_of(df):
    return etl.latest_value(df, "updated_at")


def q_incremental_extract(spark, sf):
    o = roles.etl_orders(spark, sf)
    return etl.changed_since(o, _as_of(o), days=1)


def q_product_supplier_extract(spark, sf):
    from sparkmart.sinks.files import write_parquet
    # the parts' dates come from an aggregate: computed once, used for the newest date and the rows
    p = spark.read.parquet(write_parquet(roles.etl_products(spark, sf), spark, "products"))
    return etl.product_supplier_extract(p, roles.etl_suppliers(spark, sf), _as_of(p), days=1)


def _all_products(spark, sf):
    """Full reload: every product with its supplier (no date window)."""
    p = roles.etl_products(spark, sf)
    return etl.product_supplier_extract(p, roles.etl_suppliers(spark, sf), days=None)


def q_transform_products(spark, sf):
    return etl.transform_products(_all_products(spark, sf))


def q_transform_customers(spark, sf):
    return etl.transform_customers(roles.etl_customers(spark, sf))


def q_transform_orders(spark, sf):
    return etl.transform_orders(roles.etl_orders(spark, sf))


def q_negative_amounts(spark, sf):
    return etl.negative_amounts(roles.accounts(spark, sf))


def q_upsert_orders(spark, sf):
    o = roles.etl_orders(spark, sf)
    as_of = _as_of(o)
    target = etl.unchanged_before(o, as_of, days=90)
    updates = etl.transform_orders(etl.changed_since(o, as_of, days=180))
    return etl.load_dimension(target, updates, "id", ["updated_at"])


def q_upsert_orders_buckets(spark, sf):
    """The same upsert into a kept table: two batches of updates, each its own commit, which
    rewrite the buckets that they touch."""
    from sparkmart.session import scratch_dir
    from sparkmart.sinks.buckets import BucketedTable
    o = roles.etl_orders(spark, sf)
    as_of = _as_of(o)
    kept = BucketedTable(spark, scratch_dir(spark, "orders_buckets"), ["id"], BUCKETS)
    kept.create(etl.unchanged_before(o, as_of, days=90), "1")
    changed = etl.transform_orders(etl.changed_since(o, as_of, days=180))
    for version, batch in (("2", etl.unchanged_before(changed, as_of, days=30)), ("3", etl.changed_since(changed, as_of, days=30))):
        kept.upsert(batch, ["updated_at"], version)
    return kept.read()


def q_upsert_customers(spark, sf):
    c = roles.etl_customers(spark, sf)
    as_of = _as_of(c)
    target = etl.unchanged_before(c, as_of, days=365)
    updates = etl.transform_customers(etl.changed_since(c, as_of, days=730))
    return etl.load_dimension(target, updates, "id", ["updated_at"])


def q_upsert_products(spark, sf):
    p = _all_products(spark, sf)
    as_of = _as_of(p)
    target = etl.unchanged_before(p, as_of, days=365) \
        .withColumn("margin_pct", F.lit(None).cast("double"))
    updates = etl.transform_products(etl.changed_since(p, as_of, days=730))
    return etl.load_dimension(target, updates, "id", ["updated_at"])


def q_price_with_tax(spark, sf):
    """The three tasks: extract, transform and the guarded load, read back."""
    from sparkmart.session import scratch_dir
    path = tasks.load_task(tasks.transform_task(roles.priced_items(spark, sf)), scratch_dir(spark, "priced"))
    return spark.read.parquet(path)


_ETL_SQL = r"""eo AS (SELECT o_orderkey AS id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
        CASE WHEN o_orderkey % 37 <> 0 THEN o_orderstatus END AS status,
        CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 43 = 0 THEN -o_totalprice
             ELSE o_totalprice END AS total_amount, o_orderdate AS updated_at FROM orders),
  eo_t AS (SELECT id, customer_id, order_date, lower(coalesce(status, '')) AS status,
        CASE WHEN coalesce(total_amount, 0) < 0 THEN 0 ELSE coalesce(total_amount, 0) END AS total_amount,
        updated_at FROM eo),
  last_order AS (SELECT o_custkey, max(o_orderdate) AS updated_at FROM orders GROUP BY 1),
  ec AS (SELECT c_custkey AS id, c_name AS name,
        lower(replace(c_name, '#', '.')) || '@example.com' AS email,
        CAST(c_nationkey AS VARCHAR) || ' ' || substr(lpad(CAST(c_custkey AS VARCHAR), 8, '0'), 1, 4)
          || '.' || substr(lpad(CAST(c_custkey AS VARCHAR), 8, '0'), 5, 4) AS phone,
        lower(substr(c_mktsegment, 1, 2)) AS state, updated_at
        FROM customer LEFT JOIN last_order ON c_custkey = o_custkey),
  ec_t AS (SELECT id, name, email,
        CASE WHEN length(regexp_replace(phone, '\D', '', 'g')) = 10 THEN
          '(' || substr(regexp_replace(phone, '\D', '', 'g'), 1, 3) || ') '
          || substr(regexp_replace(phone, '\D', '', 'g'), 4, 3) || '-'
          || substr(regexp_replace(phone, '\D', '', 'g'), 7, 4) ELSE phone END AS phone,
        upper(state) AS state, updated_at FROM ec),
  ship AS (SELECT l_partkey, min(l_suppkey) AS supplier_id, max(l_shipdate) AS updated_at
        FROM lineitem GROUP BY 1),
  ep AS (SELECT p_partkey AS id, p_name AS product_name, lower(p_type) || ' ' || p_name AS category,
        CASE WHEN p_partkey % 97 = 0 THEN 0 ELSE p_retailprice END AS price,
        p_retailprice * (100 - p_size) / 100 AS cost,
        CASE WHEN p_partkey % 89 <> 0 THEN supplier_id END AS supplier_id, updated_at
        FROM part LEFT JOIN ship ON p_partkey = l_partkey),
  eps AS (SELECT p.id, product_name, category, price, cost, updated_at, s_name AS supplier_name
        FROM ep p JOIN supplier s ON p.supplier_id = s.s_suppkey),
  eps_t AS (SELECT id, product_name,
        list_aggr(list_transform(string_split(category, ' '),
                  lambda x: upper(x[1]) || lower(x[2:])), 'string_agg', ' ') AS category,
        price, cost, updated_at, supplier_name, (price - cost) / nullif(price, 0) * 100 AS margin_pct
        FROM eps)
"""


def _upsert_sql(src, src_t, older_days, window_days, target_cols=None):
    target_cols = target_cols or f"{src}.*"
    return f"""
  cut AS (SELECT CAST(max(updated_at) AS DATE) AS d FROM {src}),
  tgt AS (SELECT {target_cols} FROM {src}, cut WHERE updated_at IS NULL
    OR updated_at < CAST(cut.d - INTERVAL {older_days} DAY AS TIMESTAMP)),
  upd AS (SELECT {src_t}.* FROM {src_t}, cut WHERE updated_at >= CAST(cut.d - INTERVAL {window_days} DAY AS TIMESTAMP)),
  lst AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) AS rn FROM upd) WHERE rn = 1)
SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM lst WHERE lst.id = tgt.id)
UNION ALL SELECT * FROM lst"""


# ------------------------------------------------------------ event streams

# the event feed is judged with these rule parameters (values run 0..490)
EVENT_SOURCES = ("click", "view", "purchase")
EVENT_MAX_AMOUNT = 300


def _utc_wall_clock(c):
    """An instant (TIMESTAMP) as its UTC wall-clock time (TIMESTAMP_NTZ),
    whatever the session time zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(c).cast("timestamp_ntz"))


def _ntz(df, *cols):
    return df.withColumns({c: _utc_wall_clock(c) for c in cols})


def _event_rules():
    return transactions.transaction_rules(EVENT_SOURCES, 1, EVENT_MAX_AMOUNT)


def _parsed(spark, sf):
    feed = roles.transactions_feed(spark.read.parquet(f"{sf}/events.parquet"))
    return transactions.flag_late(transactions.parse_events(feed))


def q_parse_events(spark, sf):
    return _ntz(_parsed(spark, sf).drop("is_late"), "kafka_ts", "event_time")


def q_late_events(spark, sf):
    return _ntz(_parsed(spark, sf).select("user_id", "timestamp", "event_time", "kafka_ts",
                                          "kafka_offset", "is_late"), "kafka_ts", "event_time")


def q_validate_events(spark, sf):
    v = transactions.validate(_parsed(spark, sf), _event_rules())
    return _ntz(v.select(*transactions.OUTPUT_COLUMNS), "event_time")


def q_dedup_events(spark, sf):
    return _ntz(transactions.dedup_batch(_parsed(spark, sf)).drop("is_late"),
                "kafka_ts", "event_time")


def _validated_events(spark, sf):
    feed = roles.transactions_feed(spark.read.parquet(f"{sf}/events.parquet"))
    return transactions.validate_batch(feed, _event_rules())


def q_valid_events(spark, sf):
    return _ntz(transactions.split(_validated_events(spark, sf))[0], "event_time")


def q_dlq_events(spark, sf):
    return _ntz(transactions.split(_validated_events(spark, sf))[1], "event_time")


def _messages(spark, sf, valid):
    """The split's JSON messages, written as text and parsed again."""
    from sparkmart.session import scratch_dir
    from sparkmart.sources.kafka import as_messages
    rows = transactions.split(_validated_events(spark, sf))[0 if valid else 1]
    path = scratch_dir(spark, "messages")
    as_messages(rows).write.text(path)
    return _ntz(spark.read.text(path).select(F.from_json("value", rows.schema).alias("m")).select("m.*"), "event_time")


def q_valid_messages(spark, sf):
    return _messages(spark, sf, True)


def q_dlq_messages(spark, sf):
    return _messages(spark, sf, False)


def q_window_counts(spark, sf):
    valid = transactions.split(_validated_events(spark, sf))[0]
    return _ntz(transactions.flat_windows(transactions.window_counts(valid)),
                "window_start", "window_end")


def _event_stream(spark, sf):
    """The events file replayed through the streaming file source."""
    path = f"{sf}/events.parquet"
    schema = spark.read.parquet(path).schema
    if os.path.isdir(path):  # a table written as a folder of files
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1 << 20).parquet(path)
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
            .option("maxFilesPerTrigger", 1).parquet(sf))


def _run(query):
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(str(query.exception()))


def _first_records(spark, sf):
    """The replayed stream's first record of each key, whatever the files and batches."""
    from sparkmart.session import scratch_dir
    from sparkmart.streaming import transactions as ST
    out, ck = scratch_dir(spark, "first_out"), scratch_dir(spark, "first_ck")
    feed = transactions.flag_late(transactions.parse_events(roles.transactions_feed(_event_stream(spark, sf))))
    _run(ST.start_first_records(feed, out, ck, trigger="availableNow"))
    return ST.read_first_records(spark, out)


def q_stream_dedup(spark, sf):
    return _ntz(_first_records(spark, sf).select("user_id", "amount", "timestamp", "source", "event_time"), "event_time")


# record times are cut into so many segments, and the queries restarted between them
LOG_SEGMENTS = 2
# a gap that no key of the feed outlives: as the original, which never forgets one
NEVER = "3650 days"
# what must pass after the last record until sessions of a gap are closed
CLOSING = {NEVER: "3651 days", transactions.SESSION_GAP: "2 hours"}


def _transactions_log(spark, sf):
    return roles.transactions_feed(spark.read.parquet(f"{sf}/events.parquet"))


def _replayed(spark, feed, order, run, closing=None):
    from sparkmart.session import scratch_dir
    from sparkmart.streaming.replay import replay
    replay(feed, scratch_dir(spark, "log"), order, LOG_SEGMENTS, run, closing)


def _stream_messages(spark, sf, valid):
    """Deduplicated, validated and split in the stream, appended as JSON messages, read back."""
    from sparkmart.session import scratch_dir
    from sparkmart.streaming import transactions as ST
    out, ck, feed = scratch_dir(spark, "messages_out"), scratch_dir(spark, "messages_ck"), _transactions_log(spark, sf)

    def run(stream):
        _run(ST.start_message_sink(ST.session_validated_stream(stream, _event_rules(), gap=NEVER), valid, out, ck, "availableNow"))

    _replayed(spark, feed, "timestamp", run, CLOSING[NEVER])
    schema = transactions.validate_batch(feed, _event_rules()).schema
    return _ntz(ST.read_messages(spark, out, schema), "event_time")


def q_stream_valid(spark, sf):
    return _stream_messages(spark, sf, True)


def q_stream_dlq(spark, sf):
    return _stream_messages(spark, sf, False)


def q_stream_session_dedup(spark, sf):
    """First records of sessions, whose state ends; all rows, validated, as the stream appended them."""
    from sparkmart.session import scratch_dir
    from sparkmart.streaming import transactions as ST
    out, ck = scratch_dir(spark, "session_out"), scratch_dir(spark, "session_ck")

    def run(stream):
        rows = ST.session_validated_stream(stream, _event_rules()).select(*transactions.OUTPUT_COLUMNS)
        _run(ST.start_rows(rows, out, ck, "availableNow"))

    _replayed(spark, _transactions_log(spark, sf), "timestamp", run, CLOSING[transactions.SESSION_GAP])
    return _ntz(spark.read.parquet(out), "event_time")


class _FailsOnce:
    """A ``foreachBatch`` sink that runs one batch through, so that its state is committed, and
    then fails before anything is written; the next time it works."""

    def __init__(self, sink, batch_id):
        self.sink, self.batch_id = sink, batch_id

    def __call__(self, batch, batch_id):
        if batch_id == self.batch_id:
            self.batch_id = None
            batch.write.format("noop").mode("overwrite").save()
            raise RuntimeError("the sink is away")
        self.sink(batch, batch_id)


def q_stream_supervised(spark, sf):
    """Valid messages, dead letters and the window report in one application; the report's sink
    fails once, all three stop and go on from their checkpoints."""
    from sparkmart.session import scratch_dir
    from sparkmart.streaming import transactions as ST
    from sparkmart.streaming.sinks import WindowReport, read_windows
    from sparkmart.streaming.state import state_kept, state_on_disk
    from sparkmart.streaming.supervisor import run_with_restarts
    root, feed = scratch_dir(spark, "supervised"), _transactions_log(spark, sf)
    report = _FailsOnce(WindowReport(f"{root}/report"), 1)
    failures = []

    def run(stream):
        def messages(name, valid):
            v = ST.session_validated_stream(stream, _event_rules())
            return lambda: ST.start_message_sink(v, valid, f"{root}/{name}", f"{root}/ck_{name}", "availableNow")

        with state_kept(spark, state_on_disk(spark)):
            failures.extend(run_with_restarts({
                "valid": messages("valid", True), "dlq": messages("dlq", False),
                "report": lambda: ST.start_window_report(ST.validated_stream(stream, _event_rules()), f"{root}/report", f"{root}/ck_report",
                                                         trigger="availableNow", report=report)[0]}))

    _replayed(spark, feed, "timestamp", run, CLOSING[transactions.SESSION_GAP])
    if [f.name for f in failures] != ["report"]:
        raise RuntimeError(f"failures: {failures}")
    schema = transactions.validate_batch(feed, _event_rules()).schema
    count = F.count(F.lit(1)).alias("n")
    parts = [ST.read_messages(spark, f"{root}/{name}", schema).groupBy(F.lit(name).alias("output"), F.col(label).alias("label")).agg(count)
             for name, label in (("valid", "source"), ("dlq", "error_reason"))]
    windows = _ntz(read_windows(spark, f"{root}/report"), "window_start")
    parts.append(windows.select(F.lit("report").alias("output"), F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("label"),
                                F.col("running_total").alias("n")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_stream_row_counts(spark, sf):
    """Rows read, kept, valid, dead and dropped behind the watermark, counted while the stream runs."""
    from sparkmart.session import scratch_dir
    from sparkmart.streaming import transactions as ST
    from sparkmart.streaming.counts import BatchCounts, counted, total_counts
    from sparkmart.streaming.replay import HEARTBEAT_USER
    root = scratch_dir(spark, "counted")

    def run(stream):
        parsed = transactions.flag_late(transactions.parse_events(stream))
        read = counted(parsed, "before", read=~F.col("user_id").eqNullSafe(HEARTBEAT_USER))
        v = transactions.validate(transactions.first_per_session(read), _event_rules())
        rows = counted(v, "after", kept=F.lit(True), valid=F.col("is_valid"), dead_letters=~F.col("is_valid"))
        query = ST.start_rows(rows.select(*transactions.OUTPUT_COLUMNS), f"{root}/out", f"{root}/ck", "availableNow", name="transactions")
        _run(query)
        counts.wait(query)

    with BatchCounts(spark, f"{root}/counts") as counts:
        _replayed(spark, _transactions_log(spark, sf), "timestamp", run, CLOSING[transactions.SESSION_GAP])
    return total_counts(spark, f"{root}/counts").select("name", "rows")


def _window_report(spark, sf):
    from sparkmart.session import scratch_dir
    from sparkmart.streaming import transactions as ST
    out, ck = scratch_dir(spark, "report_out"), scratch_dir(spark, "report_ck")
    v = ST.validated_stream(roles.transactions_feed(_event_stream(spark, sf)), _event_rules())
    q, _ = ST.start_window_report(v, out, ck, trigger="availableNow")
    _run(q)
    return out


def q_stream_window_counts(spark, sf):
    from sparkmart.streaming.sinks import read_windows
    return _ntz(read_windows(spark, _window_report(spark, sf)), "window_start", "window_end")


def q_stream_batch_totals(spark, sf):
    from sparkmart.streaming.sinks import read_totals
    return read_totals(spark, _window_report(spark, sf)).select("batch_id", "windows", "total")


def _activity(spark, sf):
    feed = roles.activity_feed(spark.read.parquet(f"{sf}/events.parquet"))
    return activity.parse_activity(feed)


def q_activity_events(spark, sf):
    """Decoded messages with their record data and event time."""
    return _ntz(_activity(spark, sf).select("key", "partition", "offset", "event_time", "action", "amount"), "event_time")


def q_key_event_counts(spark, sf):
    return activity.key_event_counts(_activity(spark, sf))


def q_key_running_count(spark, sf):
    return activity.key_running_count(_activity(spark, sf)) \
        .select("key", "partition", "offset", "running_count")


def q_key_partition_assignment(spark, sf):
    return _activity(spark, sf).select("key", "partition").distinct()


def q_key_event_counts_stream(spark, sf):
    from sparkmart.session import scratch_dir
    from sparkmart.streaming import activity as SA
    out, ck = scratch_dir(spark, "keys_out"), scratch_dir(spark, "keys_ck")
    _run(SA.start_key_counts(roles.activity_feed(_event_stream(spark, sf)), out, ck, trigger="availableNow"))
    return SA.read_key_counts(spark, out)


def q_key_running_count_stream(spark, sf):
    """The count after each event, from state that outlives restarts."""
    from sparkmart.session import scratch_dir
    from sparkmart.streaming import activity as SA
    out, ck = scratch_dir(spark, "running_out"), scratch_dir(spark, "running_ck")
    feed = roles.activity_feed(spark.read.parquet(f"{sf}/events.parquet"))
    _replayed(spark, feed, "offset", lambda stream: _run(SA.start_running_counts(stream, out, ck, "availableNow")))
    return spark.read.parquet(out)


def q_key_counts_after_crash(spark, sf):
    """Counts by key, from the sink and from the state, of a stream stopped between the commit of
    its state and that of its sink, and resumed."""
    from sparkmart.session import scratch_dir
    from sparkmart.streaming import activity as SA
    from sparkmart.streaming.sinks import BatchFolderSink
    from sparkmart.streaming.supervisor import run_with_restarts
    out, ck = scratch_dir(spark, "crash_out"), scratch_dir(spark, "crash_ck")
    feed = roles.activity_feed(spark.read.parquet(f"{sf}/events.parquet"))
    sink = _FailsOnce(BatchFolderSink(out), 1)

    def run(stream):
        run_with_restarts({"counts": lambda: SA.start_key_counts(stream, out, ck, "availableNow", sink=sink)})

    _replayed(spark, feed, "offset", run)
    state = SA.read_state_counts(spark, ck).select("key", F.col("event_count").alias("state_count"))
    return SA.read_key_counts(spark, out).withColumnRenamed("event_count", "sink_count").join(state, "key", "full")


_EVENTS_SQL = """feed AS (
    SELECT e.event_id, e.ts, e.user_id AS uid, e.event_type, e.value, c.copy
    FROM events e JOIN (SELECT 0 AS copy UNION ALL SELECT 1 AS copy) c
      ON c.copy = 0 OR e.event_id % 53 = 0),
  parsed AS (
    SELECT CASE WHEN event_id % 101 = 0 OR event_id % 17 = 0 THEN NULL
                ELSE 'U' || CAST(uid AS VARCHAR) END AS user_id,
           CASE WHEN event_id % 101 = 0 OR event_id % 19 = 0 THEN NULL
                ELSE CAST(floor(value) AS BIGINT) END AS amount,
           CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 31 = 0 THEN 'INVALID_DATE'
                ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS timestamp,
           CASE WHEN event_id % 101 = 0 THEN NULL ELSE event_type END AS source,
           date_trunc('second', ts) + to_minutes(CAST(event_id % 7 AS BIGINT)) AS kafka_ts,
           0 AS kafka_partition,
           event_id * 2 + copy AS kafka_offset,
           CASE WHEN event_id % 101 = 0 OR event_id % 31 = 0 THEN NULL
                ELSE date_trunc('second', ts) END AS event_time
    FROM feed),
  late AS (SELECT *, CASE WHEN event_time IS NOT NULL AND
                  floor(epoch(kafka_ts)) - floor(epoch(event_time)) > 180 THEN true ELSE false END AS is_late
           FROM parsed),
  dd AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, timestamp
           ORDER BY kafka_ts, kafka_partition, kafka_offset) AS rn FROM late) WHERE rn = 1)
"""

# the first record of each session: a key's records not more than an hour apart
_SESSIONS_SQL = """,
  sd AS (SELECT * EXCLUDE (before) FROM (
    SELECT *, lag(kafka_ts) OVER (PARTITION BY user_id, timestamp ORDER BY kafka_ts, kafka_partition, kafka_offset) AS before FROM late)
    WHERE before IS NULL OR kafka_ts - before > INTERVAL 1 HOUR)
"""


def _validated_sql(src):
    return f"""SELECT *, error_reason IS NULL AS is_valid FROM (
    SELECT user_id, amount, timestamp, source, event_time,
      CASE WHEN user_id IS NULL THEN 'missing_user_id'
           WHEN amount IS NULL THEN 'missing_amount'
           WHEN timestamp IS NULL OR event_time IS NULL THEN 'invalid_timestamp'
           WHEN amount < 1 OR amount > {EVENT_MAX_AMOUNT} THEN 'amount_out_of_range'
           WHEN NOT (source IN ({", ".join(f"'{x}'" for x in EVENT_SOURCES)})) THEN 'unknown_source'
           WHEN is_late THEN 'late_event' END AS error_reason
    FROM {src})"""


_ACTIVITY_SQL = """act AS (SELECT 'user_' || CAST(user_id AS VARCHAR) AS key, event_id AS "offset" FROM events)
"""

# CRC-32 (reflected polynomial 0xEDB88320) of each distinct key, in SQL: a
# 256-entry table generated bit by bit, then a byte-by-byte fold (ASCII keys).
_KEY_PARTITION_SQL = """WITH RECURSIVE
  crc_bits(n, c, k) AS (
    SELECT CAST(i AS BIGINT), CAST(i AS UBIGINT), 0 FROM range(256) r(i)
    UNION ALL
    SELECT n, CASE WHEN c & CAST(1 AS UBIGINT) = 1
                   THEN xor(CAST(3988292384 AS UBIGINT), c >> 1) ELSE c >> 1 END, k + 1
    FROM crc_bits WHERE k < 8),
  crc_table AS (SELECT n, c FROM crc_bits WHERE k = 8),
  """ + _ACTIVITY_SQL + """,
  act_keys AS (SELECT DISTINCT key FROM act),
  fold(key, i, crc) AS (
    SELECT key, 0, CAST(4294967295 AS UBIGINT) FROM act_keys
    UNION ALL
    SELECT f.key, f.i + 1, xor(t.c, f.crc >> 8)
    FROM fold f JOIN crc_table t ON t.n = CAST(xor(f.crc,
        CAST(ascii(substr(f.key, f.i + 1, 1)) AS UBIGINT)) & CAST(255 AS UBIGINT) AS BIGINT)
    WHERE f.i < length(f.key)),
  key_part AS (SELECT key, CAST(xor(crc, CAST(4294967295 AS UBIGINT)) % 3 AS INTEGER) AS partition
               FROM fold WHERE i = length(key))
"""


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the transaction fact built from the sf0.001 tables."""
    return q_fact_transactions(spark, SMOKE_DIR)


def _comparable(df: DataFrame) -> DataFrame:
    """Engine-neutral output types for the cross-engine check: DATE becomes
    TIMESTAMP_NTZ (midnight), an instant (TIMESTAMP) its UTC wall-clock time,
    DECIMAL becomes DOUBLE.  The
    library functions themselves keep the original types."""
    from pyspark.sql.types import DateType, DecimalType, TimestampType
    casts = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, DateType):
            casts[f.name] = F.col(f.name).cast("timestamp_ntz")
        elif isinstance(f.dataType, TimestampType):
            casts[f.name] = _utc_wall_clock(f.name)
        elif isinstance(f.dataType, DecimalType):
            casts[f.name] = F.col(f.name).cast("double")
    return df.withColumns(casts) if casts else df


def _wrap(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _comparable(fn(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


try:  # the training-data subpackage can be left out
    from sparkmart.llm.queries import ORACLES as _MORE_ORACLES, QUERIES as _MORE
except ModuleNotFoundError as e:   # its own modules only: a broken install must show
    if e.name not in ("sparkmart.llm", "sparkmart.llm.queries", "corpus_pipeline"):
        raise
    _MORE, _MORE_ORACLES = {}, {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _wrap(fn) for name, fn in _QUERIES.items()} | _MORE


_QUERIES = {
        "fact_transactions": q_fact_transactions,
        "clean_orders": _clean_orders,
        "clean_order_items": _clean_items,
        "fact_preview": q_fact_preview,
        "row_count_audit": q_row_count_audit,
        "fact_roundtrip": q_fact_roundtrip,
        "fact_from_csv": q_fact_from_csv,
        "fact_bucketed": q_fact_bucketed,
        "csv_bad_lines": q_csv_bad_lines,
        "grade_report": q_grade_report,
        "price_bands": q_price_bands,
        "extent_distance": q_extent_distance,
        "top_competitors": q_top_competitors,
        "cheapest_per_group": q_cheapest_per_group,
        "contest_leaderboard": q_contest_leaderboard,
        "stg_payment": q_stg_payment,
        "int_customer_payment": q_int_customer_payment,
        "mart_customer_revenue": q_mart_customer_revenue,
        "layered_mart": q_layered_mart,
        "mart_bucketed": q_mart_bucketed,
        "quality_checks": q_quality_checks,
        "incremental_extract": q_incremental_extract,
        "product_supplier_extract": q_product_supplier_extract,
        "transform_products": q_transform_products,
        "transform_customers": q_transform_customers,
        "transform_orders": q_transform_orders,
        "negative_amounts": q_negative_amounts,
        "upsert_orders": q_upsert_orders,
        "upsert_orders_buckets": q_upsert_orders_buckets,
        "upsert_customers": q_upsert_customers,
        "upsert_products": q_upsert_products,
        "price_with_tax": q_price_with_tax,
        "parse_events": q_parse_events,
        "late_events": q_late_events,
        "validate_events": q_validate_events,
        "dedup_events": q_dedup_events,
        "valid_events": q_valid_events,
        "dlq_events": q_dlq_events,
        "valid_messages": q_valid_messages,
        "dlq_messages": q_dlq_messages,
        "window_counts": q_window_counts,
        "stream_dedup": q_stream_dedup,
        "stream_valid": q_stream_valid,
        "stream_dlq": q_stream_dlq,
        "stream_session_dedup": q_stream_session_dedup,
        "stream_supervised": q_stream_supervised,
        "stream_row_counts": q_stream_row_counts,
        "stream_window_counts": q_stream_window_counts,
        "stream_batch_totals": q_stream_batch_totals,
        "activity_events": q_activity_events,
        "key_event_counts": q_key_event_counts,
        "key_running_count": q_key_running_count,
        "key_partition_assignment": q_key_partition_assignment,
        "key_event_counts_stream": q_key_event_counts_stream,
        "key_running_count_stream": q_key_running_count_stream,
        "key_counts_after_crash": q_key_counts_after_crash,
}


def _ts(sql: str, *cols: str) -> str:
    """DATE columns of an oracle result as TIMESTAMP (see ``_comparable``)."""
    rep = ", ".join(f"CAST({c} AS TIMESTAMP) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS q"


def oracle_sql() -> dict[str, str]:
    sql = _oracle_sql()
    for name in ("fact_transactions", "clean_orders", "fact_preview", "fact_roundtrip", "fact_from_csv", "fact_bucketed",
                 "csv_bad_lines", "incremental_extract", "transform_orders", "upsert_orders", "upsert_orders_buckets"):
        sql[name] = _ts(sql[name], "order_date")
    sql["stg_payment"] = _ts(sql["stg_payment"], "payment_date")
    return sql | _MORE_ORACLES


def _oracle_sql() -> dict[str, str]:
    w = "WITH " + _ORDERS_SQL
    return {
        "fact_transactions": w + "SELECT * FROM fact",
        "clean_orders": w + "SELECT * FROM co",
        "clean_order_items": w + "SELECT * FROM ci",
        "fact_preview": w + """SELECT * FROM fact ORDER BY order_id NULLS FIRST,
            customer_id NULLS FIRST, order_date NULLS FIRST, product_id NULLS FIRST,
            quantity NULLS FIRST, price NULLS FIRST, gmv NULLS FIRST LIMIT 5""",
        "row_count_audit": w + """SELECT 'orders' AS stage, count(*) AS rows FROM co
            UNION ALL SELECT 'order_items', count(*) FROM ci
            UNION ALL SELECT 'joined', count(*) FROM fact""",
        "fact_roundtrip": w + "SELECT * FROM fact",
        "fact_from_csv": w + "SELECT * FROM fact",
        "fact_bucketed": w + "SELECT * FROM fact",
        "csv_bad_lines": w + """, bad AS (
              SELECT CASE WHEN o_orderkey % 71 = 0 THEN o_orderkey || '.0' ELSE CAST(o_orderkey AS VARCHAR) END AS id,
                     CASE WHEN o_orderkey % 37 = 0 THEN 'x,y' ELSE '"abc' END AS usr,
                     CASE WHEN o_orderkey % 83 = 0 THEN strftime(o_orderdate, '%d/%m/%Y')
                          ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
                     CAST(o_totalprice AS VARCHAR) AS price, o_orderkey % 2 AS file
              FROM orders WHERE o_orderkey % 37 = 0 OR o_orderkey % 41 = 0)
            SELECT order_id, customer_id, order_date, NULL AS line FROM co WHERE order_id % 37 <> 0 AND order_id % 41 <> 0
            UNION ALL SELECT NULL, NULL, NULL, CASE WHEN file = 0 THEN concat_ws(',', id, usr, day, price)
              ELSE concat_ws(',', price, day, usr, id) END FROM bad""",
        "grade_report": "WITH " + _GRADES_SQL + """, hit AS (
              SELECT c_custkey, grade FROM customer, g WHERE c_acctbal >= min_mark AND c_acctbal <= max_mark)
            SELECT if(hit.grade > 7, c_name, NULL) AS name, hit.grade, c_acctbal AS marks
            FROM customer LEFT JOIN hit USING (c_custkey)""",
        "price_bands": """WITH b AS (SELECT p_partkey AS band, p_retailprice AS lo, CASE WHEN p_partkey % 501 = 0 THEN NULL
                WHEN p_partkey % 500 = 0 THEN p_retailprice + 1000000 ELSE p_retailprice + p_size / 8.0 END AS hi FROM part)
            SELECT c_custkey AS id, count(band) AS bands, min(band) AS first_band
            FROM customer LEFT JOIN b ON c_acctbal >= lo AND c_acctbal <= hi GROUP BY c_custkey""",
        "extent_distance": """SELECT ROUND(ABS(min(p_retailprice) - max(p_retailprice))
            + ABS(min(CAST(p_size AS DOUBLE)) - max(CAST(p_size AS DOUBLE))), 4) AS distance FROM part""",
        "top_competitors": "WITH " + _FULL_SCORES_SQL + """, wins AS (
              SELECT l_suppkey, count(*) AS n FROM lineitem
              WHERE EXISTS (SELECT 1 FROM part, d WHERE p_partkey = l_partkey AND p_type = difficulty_level
                            AND score = CAST(trunc(l_quantity) AS INTEGER)) GROUP BY l_suppkey)
            SELECT s_suppkey AS hacker_id, s_name AS name FROM supplier, wins
            WHERE s_suppkey = l_suppkey AND n >= 2""",
        "cheapest_per_group": """WITH usable AS (
              SELECT l_orderkey, floor(l_extendedprice / 1000) * 1000 AS l_extendedprice, p_size,
                     CAST(trunc(l_quantity) AS INTEGER) AS strength
              FROM lineitem JOIN part ON p_partkey = l_partkey AND p_type != 'PROMO'),
            least AS (SELECT p_size, strength, min(l_extendedprice) AS price FROM usable GROUP BY ALL)
            SELECT l_orderkey AS id, p_size AS age, price AS coins_needed, strength AS power
            FROM usable JOIN least USING (p_size, strength) WHERE l_extendedprice = price""",
        "contest_leaderboard": """WITH m AS (
              SELECT c_custkey AS hacker_id, o_orderpriority AS challenge_id, c_name AS name,
                     MAX(o_totalprice) AS score
              FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3)
            SELECT hacker_id, name, ROUND(SUM(score), 2) AS total_score FROM m
            GROUP BY 1, 2 HAVING SUM(score) > 1000000 ORDER BY SUM(score) DESC, hacker_id""",
        "stg_payment": "WITH " + _PAYMENT_SQL + """SELECT payment_id, customer_id, staff_id, rental_id,
            CAST(amount AS DOUBLE) AS amount, CAST(amount_usd AS DOUBLE) AS amount_usd, payment_date FROM stg""",
        "int_customer_payment": "WITH " + _PAYMENT_SQL + """SELECT customer_id, first_name, last_name,
            CAST(total_amount AS DOUBLE) AS total_amount, total_transactions FROM base""",
        "mart_customer_revenue": "WITH " + _PAYMENT_SQL + """SELECT customer_id, nama_lengkap,
            CAST(total_amount AS DOUBLE) AS total_amount, total_transactions, kategori_customer FROM mart""",
        "layered_mart": "WITH " + _PAYMENT_SQL + """SELECT customer_id, nama_lengkap,
            CAST(total_amount AS DOUBLE) AS total_amount, total_transactions, kategori_customer FROM mart""",
        "mart_bucketed": "WITH " + _PAYMENT_SQL + """SELECT customer_id, nama_lengkap,
            CAST(total_amount AS DOUBLE) AS total_amount, total_transactions, kategori_customer FROM mart""",
        "quality_checks": "WITH " + _PAYMENT_SQL + """
            SELECT 'not_null(payment_id)' AS check_name,
                   CAST(count(*) FILTER (WHERE payment_id IS NULL) AS BIGINT) AS failures FROM stg
            UNION ALL SELECT 'unique(payment_id)', (SELECT count(*) FROM (SELECT payment_id FROM stg
                   WHERE payment_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1))
            UNION ALL SELECT 'accepted_values(kategori_customer)', (SELECT count(DISTINCT kategori_customer)
                   FROM mart WHERE kategori_customer NOT IN ('HIGH', 'MEDIUM', 'LOW'))
            UNION ALL SELECT 'unique(l_orderkey,l_linenumber)', (SELECT count(*) FROM (
                   SELECT l_orderkey, l_linenumber FROM lineitem
                   WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
                   GROUP BY 1, 2 HAVING count(*) > 1))
            UNION ALL SELECT 'not_null(customer_id)', count(*) FROM named WHERE customer_id IS NULL
            UNION ALL SELECT 'accepted_values(HIGH)', count(DISTINCT kategori_customer) FROM mart
                   WHERE kategori_customer <> 'HIGH'""",
        "incremental_extract": "WITH " + _ETL_SQL + """SELECT * FROM eo WHERE updated_at >=
            CAST(CAST((SELECT max(updated_at) FROM eo) AS DATE) - INTERVAL 1 DAY AS TIMESTAMP)""",
        "product_supplier_extract": "WITH " + _ETL_SQL + """SELECT * FROM eps WHERE updated_at >=
            CAST(CAST((SELECT max(updated_at) FROM ep) AS DATE) - INTERVAL 1 DAY AS TIMESTAMP)""",
        "transform_products": "WITH " + _ETL_SQL + "SELECT * FROM eps_t",
        "transform_customers": "WITH " + _ETL_SQL + "SELECT * FROM ec_t",
        "transform_orders": "WITH " + _ETL_SQL + "SELECT * FROM eo_t",
        "negative_amounts": "SELECT c_custkey AS id, c_acctbal AS total_amount FROM customer WHERE c_acctbal < 0",
        "upsert_orders": "WITH " + _ETL_SQL + "," + _upsert_sql("eo", "eo_t", 90, 180),
        "upsert_orders_buckets": "WITH " + _ETL_SQL + "," + _upsert_sql("eo", "eo_t", 90, 180),
        "upsert_customers": "WITH " + _ETL_SQL + "," + _upsert_sql("ec", "ec_t", 365, 730),
        "upsert_products": "WITH " + _ETL_SQL + "," + _upsert_sql(
            "eps", "eps_t", 365, 730, "eps.*, CAST(NULL AS DOUBLE) AS margin_pct"),
        "price_with_tax": """SELECT upper(p_name) AS name, p_retailprice AS price,
            p_retailprice * CAST(1.1 AS DOUBLE) AS price_with_tax FROM part""",
        "parse_events": "WITH " + _EVENTS_SQL + "SELECT * FROM parsed",
        "late_events": "WITH " + _EVENTS_SQL + """SELECT user_id, timestamp, event_time, kafka_ts,
            kafka_offset, is_late FROM late""",
        "validate_events": "WITH " + _EVENTS_SQL + _validated_sql("late"),
        "dedup_events": "WITH " + _EVENTS_SQL + "SELECT * EXCLUDE (is_late) FROM dd",
        "valid_events": "WITH " + _EVENTS_SQL + "SELECT * FROM (" + _validated_sql("dd") + ") WHERE is_valid",
        "dlq_events": "WITH " + _EVENTS_SQL + "SELECT * FROM (" + _validated_sql("dd") + ") WHERE NOT is_valid",
        "valid_messages": "WITH " + _EVENTS_SQL + "SELECT * FROM (" + _validated_sql("dd") + ") WHERE is_valid",
        "dlq_messages": "WITH " + _EVENTS_SQL + "SELECT * FROM (" + _validated_sql("dd") + ") WHERE NOT is_valid",
        "window_counts": "WITH " + _EVENTS_SQL + """, v AS (""" + _validated_sql("dd") + """)
            SELECT date_trunc('minute', event_time) AS window_start,
                   date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS window_end,
                   count(*) AS running_total FROM v WHERE is_valid GROUP BY 1, 2""",
        "stream_dedup": "WITH " + _EVENTS_SQL + """SELECT user_id, amount, timestamp, source, event_time
            FROM dd""",
        "stream_valid": "WITH " + _EVENTS_SQL + "SELECT * FROM (" + _validated_sql("dd") + ") WHERE is_valid",
        "stream_dlq": "WITH " + _EVENTS_SQL + "SELECT * FROM (" + _validated_sql("dd") + ") WHERE NOT is_valid",
        "stream_window_counts": "WITH " + _EVENTS_SQL + """, v AS (""" + _validated_sql("dd") + """)
            SELECT date_trunc('minute', event_time) AS window_start,
                   date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS window_end,
                   count(*) AS running_total FROM v WHERE is_valid GROUP BY 1, 2""",
        "stream_batch_totals": "WITH " + _EVENTS_SQL + """, v AS (""" + _validated_sql("dd") + """),
            w AS (SELECT count(*) AS n FROM v WHERE is_valid GROUP BY date_trunc('minute', event_time))
            SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS windows, CAST(sum(n) AS BIGINT) AS total FROM w""",
        "key_event_counts": "WITH " + _ACTIVITY_SQL + "SELECT key, count(*) AS event_count FROM act GROUP BY key",
        "key_running_count": _KEY_PARTITION_SQL + """SELECT a.key, kp.partition, a."offset",
            count(*) OVER (PARTITION BY a.key ORDER BY kp.partition, a."offset"
                           RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_count
            FROM act a JOIN key_part kp ON a.key = kp.key""",
        "activity_events": _KEY_PARTITION_SQL + """SELECT act.key, kp.partition, act."offset",
            date_trunc('second', e.ts) AS event_time, e.event_type AS action, CAST(floor(e.value) AS INTEGER) AS amount
            FROM act JOIN events e ON e.event_id = act."offset" JOIN key_part kp ON kp.key = act.key""",
        "key_partition_assignment": _KEY_PARTITION_SQL + "SELECT key, partition FROM key_part",
        "key_event_counts_stream": "WITH " + _ACTIVITY_SQL + """SELECT key, count(*) AS event_count
            FROM act GROUP BY key""",
        "key_counts_after_crash": "WITH " + _ACTIVITY_SQL + """SELECT key, count(*) AS sink_count, count(*) AS state_count
            FROM act GROUP BY key""",
        "key_running_count_stream": _KEY_PARTITION_SQL + """SELECT a.key, kp.partition, a."offset",
            count(*) OVER (PARTITION BY a.key ORDER BY kp.partition, a."offset"
                           RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_count
            FROM act a JOIN key_part kp ON a.key = kp.key""",
        "stream_session_dedup": "WITH " + _EVENTS_SQL + _SESSIONS_SQL + _validated_sql("sd"),
        "stream_supervised": "WITH " + _EVENTS_SQL + _SESSIONS_SQL + ", v AS (" + _validated_sql("sd") + "), w AS (" + _validated_sql("dd") + """)
            SELECT 'valid' AS output, source AS label, count(*) AS n FROM v WHERE is_valid GROUP BY source
            UNION ALL SELECT 'dlq', error_reason, count(*) FROM v WHERE NOT is_valid GROUP BY error_reason
            UNION ALL SELECT 'report', strftime(date_trunc('minute', event_time), '%Y-%m-%d %H:%M'), count(*) FROM w
            WHERE is_valid GROUP BY 2""",
        "stream_row_counts": "WITH " + _EVENTS_SQL + _SESSIONS_SQL + ", v AS (" + _validated_sql("sd") + """)
            SELECT 'read' AS name, count(*) AS rows FROM feed UNION ALL SELECT 'kept', count(*) FROM v
            UNION ALL SELECT 'valid', count(*) FROM v WHERE is_valid UNION ALL SELECT 'dead_letters', count(*) FROM v WHERE NOT is_valid
            UNION ALL SELECT 'dropped_by_watermark', 0""",
    }
