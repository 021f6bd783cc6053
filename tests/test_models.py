import datetime as dt
from decimal import Decimal

import pytest

from conftest import rows
from sparkmart.plans import models as M


def _payment(spark, data):
    return spark.createDataFrame(
        data, "payment_id int, customer_id int, staff_id int, rental_id int, "
              "amount decimal(5,2), payment_date timestamp")


def _customers(spark):
    return spark.createDataFrame(
        [(1, "ann", "lee"), (2, "bo", "kim"), (3, "cy", None), (4, "di", "x"), (5, "ed", "y"),
         (6, "fay", "z")], "customer_id int, first_name string, last_name string")


def test_layers_and_bands(spark):
    t = dt.datetime(2024, 1, 2, 10, 30)
    pay = _payment(spark, [
        (1, 1, 1, 1, Decimal("49.99"), t),
        (2, 2, 1, 2, Decimal("30.00"), t), (3, 2, 1, 3, Decimal("20.00"), t),  # 50: MEDIUM
        (4, 3, 1, 4, Decimal("100.00"), t),                                    # 100: MEDIUM
        (5, 4, 1, 5, Decimal("100.01"), t),                                    # HIGH
        (6, 5, 1, 6, Decimal("0.00"), t),                                      # 0: LOW
    ])
    stg = M.stg_payment(pay)
    assert dict(stg.dtypes)["amount_usd"] == "decimal(8,3)"
    assert stg.first()["payment_date"] == dt.date(2024, 1, 2)
    base = M.int_customer_payment(stg, _customers(spark))
    mart = M.mart_customer_revenue(base)
    got = {r["customer_id"]: (r["nama_lengkap"], r["total_amount"], r["total_transactions"],
                              r["kategori_customer"]) for r in mart.collect()}
    assert got[1] == ("ANN LEE", Decimal("49.99"), 1, "LOW")
    assert got[2][1:] == (Decimal("50.00"), 2, "MEDIUM")
    assert got[3] == (None, Decimal("100.00"), 1, "MEDIUM")  # NULL last name -> NULL full name
    assert got[4][3] == "HIGH"
    assert got[5][1:] == (Decimal("0.00"), 1, "LOW")
    assert got[6] == ("FAY Z", None, 0, "LOW")             # no payment: NULL sum, 0 count


def test_checks_pass_and_fail(spark):
    t = dt.datetime(2024, 1, 2)
    good = M.stg_payment(_payment(spark, [(1, 1, 1, 1, Decimal("1"), t), (2, 1, 1, 1, Decimal("2"), t)]))
    bad = M.stg_payment(_payment(spark, [(1, 1, 1, 1, Decimal("1"), t), (1, 1, 1, 1, Decimal("2"), t),
                                         (None, 1, 1, 1, Decimal("2"), t), (None, 1, 1, 1, Decimal("3"), t)]))
    mart_ok = spark.createDataFrame([("HIGH",), ("LOW",), (None,)], "kategori_customer string")
    mart_bad = spark.createDataFrame([("HIGH",), ("VIP",), ("VIP",), ("gold",)], "kategori_customer string")
    assert rows(M.model_checks(good, mart_ok), "failures") == [(0,), (0,), (0,)]
    got = {r["check_name"]: r["failures"] for r in M.model_checks(bad, mart_bad).collect()}
    assert got == {"not_null(payment_id)": 2, "unique(payment_id)": 1,
                   "accepted_values(kategori_customer)": 2}


def test_materializations(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "x int")
    M.materialize_view(df, "v_test")
    assert spark.table("v_test").count() == 1
    t = M.materialize_table(spark, df, "t_test", str(tmp_path / "t"))
    assert t.count() == 1 and spark.table("t_test").count() == 1


def test_require_rows(spark):
    from sparkmart.operators.quality import require_rows
    with pytest.raises(ValueError):
        require_rows(spark.createDataFrame([], "x int"), "empty")


def test_build_all_layers(spark, tmp_path):
    t = dt.datetime(2024, 1, 2)
    pay = _payment(spark, [(1, 1, 1, 1, Decimal("60"), t), (2, 2, 1, 2, Decimal("5"), t)])
    mart, checks = M.build(spark, pay, _customers(spark), str(tmp_path))
    assert rows(mart, "customer_id", "kategori_customer")[:2] == [(1, "MEDIUM"), (2, "LOW")]
    assert rows(checks, "failures") == [(0,), (0,), (0,)]
    assert spark.table("mart_customer_revenue").count() == 6


def test_key_checks_equal_separate_checks(spark):
    from sparkmart.operators.quality import key_checks, not_null, run_checks, unique
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,), (3,), (3,), (3,)], "k int")
    assert rows(key_checks(df, "k")) == rows(run_checks(not_null(df, "k"), unique(df, "k")))


def test_checks_from_a_schema_file(spark, tmp_path):
    from sparkmart.operators.quality import checks_from_spec, load_spec
    path = tmp_path / "schema.yml"
    path.write_text("""
version: 2
models:
  - name: stg_payment
    columns:
      - name: payment_id
        tests:
          - not_null
          - unique
  - name: mart_customer_revenue
    columns:
      - name: kategori_customer
        tests:
          - accepted_values:
              arguments:
                values: ['HIGH', 'MEDIUM', 'LOW']
""")
    t = dt.datetime(2024, 1, 2)
    stg = M.stg_payment(_payment(spark, [(1, 1, 1, 1, Decimal("1"), t), (1, 2, 1, 1, Decimal("2"), t)]))
    mart = spark.createDataFrame([("HIGH",), ("VIP",)], "kategori_customer string")
    got = dict(rows(checks_from_spec({"stg_payment": stg, "mart_customer_revenue": mart},
                                     load_spec(str(path)))))
    assert got == {"stg_payment.not_null(payment_id)": 0, "stg_payment.unique(payment_id)": 1,
                   "mart_customer_revenue.accepted_values(kategori_customer)": 1}
