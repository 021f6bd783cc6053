import datetime as dt
import os
import tempfile

from conftest import rows
from sparkmart.plans import batch_fact as B

# golden rows of the fact (order_id, customer_id, order_date, product_id, quantity, price, gmv)
GOLDEN = [
    (5001, 375, dt.date(2023, 4, 23), 483, 1, 911307.0, 911307.0),
    (5002, 201, dt.date(2023, 3, 12), 441, 3, 1028008.0, 3084024.0),
    (5003, 144, dt.date(2023, 1, 30), 325, 4, 1429849.0, 5719396.0),
    (5004, 543, dt.date(2023, 5, 15), 105, 3, 63923.0, 191769.0),
    (5005, 405, dt.date(2023, 3, 8), 406, 3, 1682060.0, 5046180.0),
]


def _orders(spark, data, with_total=True):
    cols = "order_id string, user_id string, order_date string" + (
        ", total_amount string" if with_total else "")
    return spark.createDataFrame(data, cols)


def _items(spark, data):
    return spark.createDataFrame(data, "order_id string, product_id string, quantity string, price string")


def test_golden_rows(spark):
    orders = _orders(spark, [(str(g[0]), str(g[1]), g[2].isoformat(), "1") for g in GOLDEN])
    items = _items(spark, [(str(g[0]), str(g[3]), str(g[4]), str(g[5])) for g in GOLDEN])
    fact = B.build_fact(B.clean_orders(orders), B.clean_order_items(items))
    assert tuple(fact.columns) == B.FACT_COLUMNS
    assert rows(fact) == GOLDEN
    types = dict(fact.dtypes)
    assert types["order_id"] == "int" and types["order_date"] == "date"
    assert types["quantity"] == "int" and types["price"] == "double" and types["gmv"] == "double"


def test_order_cleaning_edges(spark):
    o = _orders(spark, [("1", None, "2023-01-05"), ("2", "x", "2023-1-5"), ("3", "7", "2023-02-01")],
                with_total=False)
    got = rows(B.clean_orders(o))
    assert got == [(1, -1, dt.date(2023, 1, 5)), (2, None, None), (3, 7, dt.date(2023, 2, 1))]


def test_total_amount_dropped_only_if_present(spark):
    with_t = B.clean_orders(_orders(spark, [("1", "2", "2023-01-01", "9")]))
    without = B.clean_orders(_orders(spark, [("1", "2", "2023-01-01")], with_total=False))
    assert with_t.columns == without.columns == ["order_id", "customer_id", "order_date"]


def test_item_quantity_edges(spark):
    items = _items(spark, [("1", "10", q, "5.0") for q in ["0", "-1", None, "x", "2.5", "3", "0.5"]])
    got = rows(B.clean_order_items(items), "quantity")
    assert got == [(2,), (3,)]


def test_item_without_order_dropped(spark):
    o = _orders(spark, [("1", "2", "2023-01-01")], with_total=False)
    i = _items(spark, [("1", "5", "2", "1.5"), ("99", "5", "2", "1.5")])
    assert rows(B.build_fact(B.clean_orders(o), B.clean_order_items(i)), "order_id", "gmv") == [(1, 3.0)]


def test_csv_end_to_end_with_observed_counts(spark):
    d = tempfile.mkdtemp(prefix="fact-csv-")
    with open(os.path.join(d, "orders.csv"), "w") as f:
        f.write("order_id,user_id,order_date,total_amount\n")
        for g in GOLDEN:
            f.write(f"{g[0]},{g[1]},{g[2].isoformat()},10\n")
    with open(os.path.join(d, "order_items.csv"), "w") as f:
        f.write("order_id,product_id,quantity,price\n")
        for g in GOLDEN:
            f.write(f"{g[0]},{g[3]},{g[4]},{g[5]}\n")
        f.write("5001,1,0,10\n")  # dropped by the quantity filter
    back, counts = B.run(spark, os.path.join(d, "orders.csv"), os.path.join(d, "order_items.csv"),
                         os.path.join(d, "out"))
    assert counts == {"orders": 5, "order_items": 5, "joined": 5}
    assert rows(back) == GOLDEN
    assert B.preview(back, 5).count() == 5
