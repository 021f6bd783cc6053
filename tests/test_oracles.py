"""Every registered query against its DuckDB oracle on the sf0.001 tables."""
import os

import pytest

import __spark_entry__ as E
from compare import compare, duck

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_query_matches_oracle(spark, con, name):
    from pyspark.sql.types import DateType, DecimalType, TimestampType
    df = E.queries()[name](spark, SF)
    assert len(set(df.columns)) == len(df.columns)
    assert not [f.name for f in df.schema.fields
                if isinstance(f.dataType, (DateType, DecimalType, TimestampType))]
    if name not in ORACLES:
        assert df.count() >= 0
        return
    ok, msg = compare(df, con, ORACLES[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["order_id", "customer_id", "order_date", "product_id", "quantity",
                          "price", "gmv"]


def test_every_query_has_an_oracle():
    assert set(E._QUERIES) <= set(ORACLES)


@pytest.mark.parametrize("stream,batch", [("stream_dedup", "dedup_events"),
                                          ("stream_valid", "valid_events"),
                                          ("stream_dlq", "dlq_events"),
                                          ("stream_window_counts", "window_counts"),
                                          ("key_event_counts_stream", "key_event_counts")])
def test_stream_equals_batch(spark, stream, batch):
    from compare import rows_of_spark
    s = E.queries()[stream](spark, SF)
    b = E.queries()[batch](spark, SF).select(*s.columns)
    assert rows_of_spark(s) == rows_of_spark(b)
