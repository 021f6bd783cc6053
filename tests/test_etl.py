import datetime as dt

from conftest import rows
from sparkmart.plans import etl as E


def test_transform_customers(spark):
    df = spark.createDataFrame([(1, "555-123.4567", "ca"), (2, "+1 555 123 4567", "ny"),
                                (3, None, None), (4, "12345", "Tx")], "id int, phone string, state string")
    got = rows(E.transform_customers(df))
    assert got == [(1, "(555) 123-4567", "CA"), (2, "+1 555 123 4567", "NY"), (3, None, None),
                   (4, "12345", "TX")]


def test_transform_orders_and_negatives(spark):
    df = spark.createDataFrame([(1, "SHIPPED", -5.0), (2, None, None), (3, "Open", 12.5), (4, "x", 0.0)],
                               "id int, status string, total_amount double")
    assert rows(E.transform_orders(df)) == [(1, "shipped", 0.0), (2, "", 0.0), (3, "open", 12.5),
                                            (4, "x", 0.0)]
    assert rows(E.negative_amounts(df)) == [(1, -5.0)]


def test_transform_products(spark):
    df = spark.createDataFrame([(1, "HOME & garden", 10.0, 7.5), (2, "toys", 0.0, 1.0)],
                               "id int, category string, price double, cost double")
    got = rows(E.transform_products(df), "id", "category", "margin_pct")
    assert got == [(1, "Home & Garden", 25.0), (2, "Toys", None)]


def test_changed_since_bound_inclusive(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 3, 9, 0, 0)), (2, dt.datetime(2024, 3, 8, 23, 59)),
                                (3, None), (4, dt.datetime(2024, 3, 10, 8))], "id int, updated_at timestamp")
    got = rows(E.changed_since(df, dt.date(2024, 3, 10), days=1), "id")
    assert got == [(1,), (4,)]
    assert rows(E.unchanged_before(df, dt.date(2024, 3, 10), days=1), "id") == [(2,), (3,)]


def test_product_supplier_extract(spark):
    p = spark.createDataFrame([(1, "a", "c", 1.0, 0.5, 10, dt.datetime(2024, 3, 10)),
                               (2, "b", "c", 1.0, 0.5, 99, dt.datetime(2024, 3, 10)),
                               (3, "c", "c", 1.0, 0.5, 10, dt.datetime(2024, 1, 1))],
                              "id int, product_name string, category string, price double, cost double, "
                              "supplier_id int, updated_at timestamp")
    s = spark.createDataFrame([(10, "acme")], "id int, supplier_name string")
    got = rows(E.product_supplier_extract(p, s, dt.date(2024, 3, 10)), "id", "supplier_name")
    assert got == [(1, "acme")]  # no supplier: dropped; old: not extracted


def test_upsert_semantics(spark):
    schema = "id int, name string, email string, updated_at timestamp"
    t0, t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)
    target = spark.createDataFrame([(1, "a", "a@x", t0), (2, "b", "b@x", t0)], schema)
    updates = spark.createDataFrame([(2, "b1", "b1@x", t1), (2, "b2", None, t2),  # last wins, NULL overwrites
                                     (3, "c", "c@x", t1)], schema)
    got = rows(E.load_dimension(target, updates))
    assert got == [(1, "a", "a@x", t0), (2, "b2", None, t2), (3, "c", "c@x", t1)]
    empty = spark.createDataFrame([], schema)
    assert rows(E.load_dimension(target, empty)) == rows(target)


def test_versioned_write(spark, tmp_path):
    from sparkmart.sinks.files import write_version
    df = spark.createDataFrame([(1,)], "x int")
    p1 = write_version(df, str(tmp_path), "1")
    p2 = write_version(spark.read.parquet(p1).union(df), str(tmp_path), "2")
    assert spark.read.parquet(p2).count() == 2 and spark.read.parquet(p1).count() == 1


def test_phone_unicode_digits_like_python(spark):
    import re
    phone = "٥٥٥-123-4567"  # Arabic-Indic fives
    digits = re.sub(r"\D", "", phone)
    expect = f"({digits[:3]}) {digits[3:6]}-{digits[6:]}" if len(digits) == 10 else phone
    df = spark.createDataFrame([(1, phone, "ca")], "id int, phone string, state string")
    assert E.transform_customers(df).first()["phone"] == expect


def test_incremental_load_all_entities(spark):
    t_old, t_new = dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 10, 9)
    cust = spark.createDataFrame([(1, "a", "a@x", "5551234567", "ca", t_new), (2, "b", "b@x", "1", "ny", t_old)],
                                 "id int, name string, email string, phone string, state string, updated_at timestamp")
    prod = spark.createDataFrame([(7, "p", "big TOYS", 10.0, 5.0, 1, t_new)],
                                 "id int, product_name string, category string, price double, cost double, "
                                 "supplier_id int, updated_at timestamp")
    sup = spark.createDataFrame([(1, "acme")], "id int, supplier_name string")
    orders = spark.createDataFrame([(5, 1, dt.date(2024, 3, 10), "NEW", -3.0, t_new)],
                                   "id int, customer_id int, order_date date, status string, "
                                   "total_amount double, updated_at timestamp")
    targets = {
        "dim_customers": cust.filter("id = 2"),
        "dim_products": spark.createDataFrame([], "id int, product_name string, category string, price double, "
                                                  "cost double, updated_at timestamp, supplier_name string, "
                                                  "margin_pct double"),
        "fact_orders": orders.limit(0),
    }
    out = E.incremental_load(cust, prod, sup, orders, targets, as_of=dt.date(2024, 3, 10))
    assert rows(out["dim_customers"], "id", "phone", "state") == [(1, "(555) 123-4567", "CA"), (2, "1", "ny")]
    assert rows(out["dim_products"], "id", "category", "supplier_name", "margin_pct") == \
        [(7, "Big Toys", "acme", 50.0)]
    assert rows(out["fact_orders"], "id", "status", "total_amount") == [(5, "new", 0.0)]
