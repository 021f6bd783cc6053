import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_batch_fact_job_from_the_command_line():
    d = tempfile.mkdtemp(prefix="cli-")
    with open(os.path.join(d, "orders.csv"), "w") as f:
        f.write("order_id,user_id,order_date\n5001,375,2023-04-23\n5002,,2023-03-12\n")
    with open(os.path.join(d, "items.csv"), "w") as f:
        f.write("order_id,product_id,quantity,price\n5001,483,1,911307.0\n5002,441,3,10.5\n5002,1,0,1\n")
    out = subprocess.run(
        [sys.executable, "-m", "sparkmart", "--local", "batch-fact", "--orders", f"{d}/orders.csv",
         "--items", f"{d}/items.csv", "--out", f"{d}/fact"],
        cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert '{"orders": 2, "order_items": 2, "joined": 2}' in out.stdout
    assert "31.5" in out.stdout and "-1" in out.stdout


def test_analytics_job_from_the_command_line(spark):
    d = tempfile.mkdtemp(prefix="cli-")
    spark.createDataFrame([(1.0, 5.0), (4.0, 1.0)], "lat_n double, long_w double") \
        .write.parquet(f"{d}/station")
    out = subprocess.run(
        [sys.executable, "-m", "sparkmart", "--local", "analytics", "--tables", d,
         "--query", "extent_distance", "--out", f"{d}/result"],
        cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert spark.read.parquet(f"{d}/result").first()["distance"] == 7.0


def test_load_job_writes_new_versions(spark):
    import datetime as dt
    import json
    d = tempfile.mkdtemp(prefix="cli-")
    t_new = dt.datetime(2024, 3, 10, 9)
    cust = spark.createDataFrame([(1, "a", "a@x", "5551234567", "ca", t_new)],
                                 "id int, name string, email string, phone string, state string, updated_at timestamp")
    prod = spark.createDataFrame([(7, "p", "toys", 10.0, 5.0, 1, t_new)],
                                 "id int, product_name string, category string, price double, cost double, "
                                 "supplier_id int, updated_at timestamp")
    sup = spark.createDataFrame([(1, "acme")], "id int, supplier_name string")
    orders = spark.createDataFrame([(5, 1, dt.date(2024, 3, 10), "NEW", 3.0, t_new)],
                                   "id int, customer_id int, order_date date, status string, "
                                   "total_amount double, updated_at timestamp")
    for name, df in {"customers": cust, "products": prod, "suppliers": sup, "orders": orders}.items():
        df.write.parquet(f"{d}/src/{name}")
    cust.limit(0).write.parquet(f"{d}/tgt/dim_customers")
    orders.limit(0).write.parquet(f"{d}/tgt/fact_orders")
    spark.createDataFrame([], "id int, product_name string, category string, price double, cost double, "
                              "updated_at timestamp, supplier_name string, margin_pct double") \
        .write.parquet(f"{d}/tgt/dim_products")
    out = subprocess.run(
        [sys.executable, "-m", "sparkmart", "--local", "load", "--source", f"{d}/src",
         "--target", f"{d}/tgt", "--out", f"{d}/out", "--as-of", "2024-03-10"],
        cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    paths = json.loads(out.stdout.strip().splitlines()[-1])
    assert spark.read.parquet(paths["fact_orders"]).first()["status"] == "new"
    assert spark.read.parquet(paths["dim_customers"]).first()["phone"] == "(555) 123-4567"
    # a second load takes the first one's output as its target
    from sparkmart.sinks.files import read_current
    spark.createDataFrame([(5, 1, dt.date(2024, 3, 10), "DONE", 4.0, t_new + dt.timedelta(hours=1)),
                           (6, 1, dt.date(2024, 3, 10), "NEW", 1.0, t_new)], orders.schema) \
        .write.mode("overwrite").parquet(f"{d}/src/orders")
    out = subprocess.run(
        [sys.executable, "-m", "sparkmart", "--local", "load", "--source", f"{d}/src",
         "--target", f"{d}/out", "--out", f"{d}/out", "--as-of", "2024-03-10"],
        cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    now = read_current(spark, f"{d}/out", "fact_orders")
    assert sorted((r["id"], r["status"], r["total_amount"]) for r in now.collect()) == [(5, "done", 4.0), (6, "new", 1.0)]
    assert now.columns == orders.columns


def test_models_job_with_a_schema_file(spark):
    import datetime as dt
    from decimal import Decimal
    d = tempfile.mkdtemp(prefix="cli-")
    spark.createDataFrame([(1, 1, 1, 1, Decimal("60.00"), dt.datetime(2024, 1, 2))],
                          "payment_id int, customer_id int, staff_id int, rental_id int, "
                          "amount decimal(5,2), payment_date timestamp").write.parquet(f"{d}/payment")
    spark.createDataFrame([(1, "ann", "lee")], "customer_id int, first_name string, last_name string") \
        .write.parquet(f"{d}/customer")
    with open(f"{d}/schema.yml", "w") as f:
        f.write("models:\n  - name: stg_payment\n    columns:\n      - name: payment_id\n"
                "        tests: [not_null, unique]\n")
    out = subprocess.run(
        [sys.executable, "-m", "sparkmart", "--local", "models", "--payment", f"{d}/payment",
         "--customer", f"{d}/customer", "--out", f"{d}/tables", "--schema", f"{d}/schema.yml"],
        cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "stg_payment.unique(payment_id)" in out.stdout


def test_transactions_job_stops_and_restarts_all(spark, monkeypatch, tmp_path):
    """The three queries over a file log in place of topics; the dead-letter topic is away at first."""
    from events_fixture import SCHEMA, T0, msg
    from sparkmart.sources.kafka import as_messages
    from sparkmart.streaming import apps
    spark.createDataFrame([msg(1, T0, "S1", 10), msg(2, T0, None, 10)], SCHEMA).write.parquet(f"{tmp_path}/log")
    tries = []

    def write(df, servers, topic, checkpoint, **_):
        tries.append(topic)
        if topic == "transactions_dlq" and tries.count(topic) == 1:
            raise OSError("no such topic")
        return as_messages(df).writeStream.format("text").option("path", f"{tmp_path}/{topic}") \
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    monkeypatch.setattr(apps, "read_kafka_stream", lambda *a: spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/log"))
    monkeypatch.setattr(apps, "write_kafka_stream", write)
    from sparkmart.streaming.supervisor import run_with_restarts
    starters = apps.transaction_starters(spark, "nowhere", f"{tmp_path}/ck", f"{tmp_path}/report", trigger="availableNow")
    failures = run_with_restarts(starters, restarts=1)
    assert [f.name for f in failures] == ["dlq"] and tries == ["transactions_valid", "transactions_dlq"] * 2
    assert spark.read.text(f"{tmp_path}/transactions_valid").count() == spark.read.text(f"{tmp_path}/transactions_dlq").count() == 1
    assert not spark.streams.active
