"""The driver's tables cast in the roles the workloads expect.

Each function reads whole tables and only renames, retypes or derives
columns, so the work of every query grows with the data.  Where a workload
must see bad input (text in numeric fields, missing values, junk messages,
redelivered messages), the fault is injected deterministically from the row's
own key; no row is removed by these rules.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.sources.tables import load

# parameters of the fault injection (ours): one in n keys gets each kind of bad cell
ORDER_USER_NULL, ORDER_USER_TEXT, ORDER_DATE_BAD, ORDER_USER_POINT, ORDER_ID_POINT = 97, 89, 83, 79, 71
ITEM_QTY_ZERO, ITEM_QTY_FRACTION, ITEM_QTY_TEXT, ITEM_QTY_NULL, ITEM_QTY_NEG = 101, 103, 107, 109, 113
EVENT_USER_NULL, EVENT_AMOUNT_TEXT, EVENT_TIME_BAD, EVENT_JUNK, EVENT_REDELIVERED = 17, 19, 31, 101, 53
ETL_STATUS_NULL, ETL_AMOUNT_NULL, ETL_AMOUNT_NEG, PRODUCT_FREE, PRODUCT_NO_SUPPLIER = 37, 41, 43, 97, 89
WAND_COIN_STEP = 1000  # coins in whole thousands, so that equal minima occur
EVENT_LAG_STEPS = 7  # record time = event time + (event_id mod 7) minutes


def _every(c: str, n: int):
    """True for one key in ``n`` (the key is a multiple of n)."""
    return (F.col(c) % F.lit(n)) == 0


def _with_point(c: str):
    """A key as text, for one key in ORDER_ID_POINT as '12.0' (a column that once held a missing value)."""
    text = F.col(c).cast("string")
    return F.when(_every(c, ORDER_ID_POINT), F.concat(text, F.lit(".0"))).otherwise(text)


# ---- batch fact (CSV text) -------------------------------------------------

def csv_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return o.select(
        _with_point("o_orderkey").alias("order_id"),
        F.when(_every("o_orderkey", ORDER_USER_NULL), F.lit(None).cast("string"))
         .when(_every("o_orderkey", ORDER_USER_TEXT), F.lit("x"))
         .when(_every("o_orderkey", ORDER_USER_POINT), F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
         .otherwise(F.col("o_custkey").cast("string")).alias("user_id"),
        F.when(_every("o_orderkey", ORDER_DATE_BAD), F.date_format("o_orderdate", "dd/MM/yyyy"))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_date"),
        F.col("o_totalprice").cast("string").alias("total_amount"))


def csv_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    qty = (F.when(_every("l_orderkey", ITEM_QTY_ZERO), F.lit("0"))
           .when(_every("l_orderkey", ITEM_QTY_FRACTION), F.lit("2.5"))
           .when(_every("l_orderkey", ITEM_QTY_TEXT), F.lit("x"))
           .when(_every("l_orderkey", ITEM_QTY_NULL), F.lit(None).cast("string"))
           .when(_every("l_orderkey", ITEM_QTY_NEG), F.lit("-1"))
           .otherwise(F.col("l_quantity").cast("string")))
    return li.select(_with_point("l_orderkey").alias("order_id"),
                     F.col("l_partkey").cast("string").alias("product_id"),
                     qty.alias("quantity"),
                     F.col("l_extendedprice").cast("string").alias("price"))


# ---- analytic queries --------------------------------------------------------

def students(spark, sf_dir):
    return load(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("marks"))


def grades(spark, bands: int = 10, width: float = 1000.0):
    """Grade g covers [width*(g-1), width*(g-1) + width - 0.01], g = 1..bands."""
    return spark.range(1, bands + 1).select(
        F.col("id").cast("int").alias("grade"),
        ((F.col("id") - 1) * F.lit(width)).cast("double").alias("min_mark"),
        ((F.col("id") - 1) * F.lit(width) + F.lit(width - 0.01)).cast("double").alias("max_mark"))


def station(spark, sf_dir):
    return load(spark, sf_dir, "part").select(
        F.col("p_retailprice").alias("lat_n"), F.col("p_size").cast("double").alias("long_w"))


def ship_submissions(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("hacker_id"), F.col("l_partkey").alias("challenge_id"),
        F.col("l_quantity").cast("int").alias("score"))


def supplier_hackers(spark, sf_dir):
    return load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("hacker_id"), F.col("s_name").alias("name"))


def part_challenges(spark, sf_dir):
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("challenge_id"), F.col("p_type").alias("difficulty_level"))


# parameters (ours): the full score of each difficulty level (part type)
FULL_SCORES = [("ECONOMY", 10), ("LARGE", 20), ("MEDIUM", 30), ("PROMO", 40),
               ("SMALL", 45), ("STANDARD", 50)]


def difficulty(spark):
    return spark.createDataFrame(FULL_SCORES, "difficulty_level string, score int")


def wands(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("code"),
        (F.floor(F.col("l_extendedprice") / WAND_COIN_STEP) * WAND_COIN_STEP).cast("double").alias("coins_needed"),
        F.col("l_quantity").cast("int").alias("power"))


def wand_properties(spark, sf_dir):
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("code"), F.col("p_size").alias("age"),
        F.when(F.col("p_type") == "PROMO", 1).otherwise(0).alias("is_evil"))


def order_submissions(spark, sf_dir):
    return load(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("hacker_id"), F.col("o_orderpriority").alias("challenge_id"),
        F.col("o_totalprice").alias("score"))


def customer_hackers(spark, sf_dir):
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("hacker_id"), F.col("c_name").alias("name"))


# ---- layered models ------------------------------------------------------------

def payment(spark, sf_dir):
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("payment_id"), F.col("o_custkey").alias("customer_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("staff_id"),
        F.col("o_orderkey").alias("rental_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        F.col("o_orderdate").alias("payment_date"),
        F.col("o_orderstatus").alias("status"))


PAYMENT_UNNAMED = 7  # parameter (ours): the customers of every 7th key are not named in payments


def named_payment(spark, sf_dir):
    """All payments; those of every 7th customer key name no customer."""
    p = payment(spark, sf_dir)
    return p.withColumn("customer_id", F.when(~_every("customer_id", PAYMENT_UNNAMED), F.col("customer_id")))


def model_customer(spark, sf_dir):
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"))


# ---- incremental ETL -----------------------------------------------------------

def etl_orders(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer_id"),
                    F.col("o_orderdate").cast("date").alias("order_date"),
                    F.when(~_every("o_orderkey", ETL_STATUS_NULL), F.col("o_orderstatus")).alias("status"),
                    F.when(_every("o_orderkey", ETL_AMOUNT_NULL), F.lit(None).cast("double"))
                     .when(_every("o_orderkey", ETL_AMOUNT_NEG), -F.col("o_totalprice"))
                     .otherwise(F.col("o_totalprice")).alias("total_amount"),
                    F.col("o_orderdate").alias("updated_at"))


def etl_customers(spark, sf_dir):
    """Customers; updated_at = date of their latest order (aggregated before the join)."""
    c = load(spark, sf_dir, "customer")
    last = load(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.max("o_orderdate").alias("updated_at"))
    key = F.lpad(F.col("c_custkey").cast("string"), 8, "0")
    return (c.join(last, c["c_custkey"] == last["o_custkey"], "left")
            .select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                    F.concat(F.lower(F.regexp_replace("c_name", "#", ".")),
                             F.lit("@example.com")).alias("email"),
                    F.concat(F.col("c_nationkey").cast("string"), F.lit(" "),
                             F.substring(key, 1, 4), F.lit("."),
                             F.substring(key, 5, 4)).alias("phone"),
                    F.lower(F.substring("c_mktsegment", 1, 2)).alias("state"),
                    "updated_at"))


def etl_products(spark, sf_dir):
    """Parts; supplier = lowest supplier key that shipped the part, updated_at =
    its latest shipment (one aggregate over lineitem); cost = price less p_size percent."""
    p = load(spark, sf_dir, "part")
    ship = load(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.min("l_suppkey").alias("supplier_id"), F.max("l_shipdate").alias("updated_at"))
    price = F.when(_every("p_partkey", PRODUCT_FREE), F.lit(0.0)).otherwise(F.col("p_retailprice"))
    return (p.join(ship, p["p_partkey"] == ship["l_partkey"], "left")
            .select(F.col("p_partkey").alias("id"), F.col("p_name").alias("product_name"),
                    F.concat(F.lower("p_type"), F.lit(" "), F.col("p_name")).alias("category"),
                    price.alias("price"),
                    (F.col("p_retailprice") * (F.lit(100) - F.col("p_size")) / F.lit(100))
                    .alias("cost"),
                    F.when(~_every("p_partkey", PRODUCT_NO_SUPPLIER), F.col("supplier_id")).alias("supplier_id"),
                    "updated_at"))


def etl_suppliers(spark, sf_dir):
    return load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("supplier_name"))


def accounts(spark, sf_dir):
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("total_amount"))


BAND_WIDE, BAND_OPEN = 500, 501  # parameters (ours): every n-th band is very wide, or has no upper end


def price_bands(spark, sf_dir):
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("band"), F.col("p_retailprice").alias("lo"),
        F.when(_every("p_partkey", BAND_OPEN), F.lit(None).cast("double"))
         .when(_every("p_partkey", BAND_WIDE), F.col("p_retailprice") + 1_000_000)
         .otherwise(F.col("p_retailprice") + F.col("p_size") / 8.0).alias("hi"))


def priced_items(spark, sf_dir):
    return load(spark, sf_dir, "part").select(
        F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"))


# ---- event streams -------------------------------------------------------------

def _epoch_seconds_utc(c: str):
    """Whole seconds since 1970-01-01 of a wall-clock (TIMESTAMP_NTZ) value read
    as UTC, independent of the session time zone."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(c))


def _json_text(c):
    return F.when(c.isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), c, F.lit('"')))


def transactions_feed(events: DataFrame) -> DataFrame:
    """``events`` as messages of the transaction topic (works on a stream too).

    user_id 'U<n>', amount = whole part of value, ISO timestamp text, source =
    event_type; record time = event second + (event_id mod 7) minutes, so lags
    of 0..6 minutes occur (3 minutes is exactly on time).  Injected faults:
    NULL user, amount sent as text, unparseable time, junk message, and
    messages delivered twice (same record time, next offset).
    """
    def k(n):
        return _every("event_id", n)

    amount = F.floor("value").cast("long").cast("string")
    body = F.concat(
        F.lit('{"user_id":'),
        _json_text(F.when(k(EVENT_USER_NULL), F.lit(None).cast("string"))
                   .otherwise(F.concat(F.lit("U"), F.col("user_id").cast("string")))),
        F.lit(',"amount":'),
        F.when(k(EVENT_AMOUNT_TEXT), _json_text(amount)).otherwise(amount),
        F.lit(',"timestamp":'),
        _json_text(F.when(k(EVENT_TIME_BAD), F.lit("INVALID_DATE"))
                   .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))),
        F.lit(',"source":'), _json_text(F.col("event_type")), F.lit("}"))
    copies = F.when(k(EVENT_REDELIVERED), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return events.select(
        F.lit(None).cast("string").alias("key"),
        F.when(k(EVENT_JUNK), F.lit("not json")).otherwise(body).alias("value"),
        F.lit("transactions").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id"),
        F.timestamp_seconds(_epoch_seconds_utc("ts") +
                            (F.col("event_id") % F.lit(EVENT_LAG_STEPS)) * 60).alias("timestamp"),
        F.explode(copies).alias("copy")) \
        .select("key", "value", "topic", "partition",
                (F.col("event_id") * 2 + F.col("copy")).alias("offset"), "timestamp")


def activity_feed(events: DataFrame, partitions: int = 3) -> DataFrame:
    """``events`` as keyed activity messages: key 'user_<n>', value JSON with
    epoch seconds, action and whole amount; partition chosen from the key;
    offset = event_id."""
    from sparkmart.functions.partition import key_partition
    key = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    value = F.to_json(F.struct(_epoch_seconds_utc("ts").alias("timestamp"),
                               F.col("event_type").alias("action"),
                               F.floor("value").cast("int").alias("amount")))
    return events.select(key.alias("key"), value.alias("value"),
                         F.lit("events_topic").alias("topic"),
                         key_partition(key, partitions).alias("partition"),
                         F.col("event_id").alias("offset"),
                         F.timestamp_seconds(_epoch_seconds_utc("ts")).alias("timestamp"))
