import os
import tempfile

from conftest import rows
from sparkmart.sources.files import read_csv_strings


def test_csv_strings_from_header_and_declared(spark):
    d = tempfile.mkdtemp(prefix="csv-")
    p = os.path.join(d, "a.csv")
    with open(p, "w") as f:
        f.write("order_id,user_id,order_date\n1,7,2023-01-01\n2,,2023-1-5\n")
    df = read_csv_strings(spark, p)
    assert df.dtypes == [("order_id", "string"), ("user_id", "string"), ("order_date", "string")]
    assert rows(df) == [("1", "7", "2023-01-01"), ("2", None, "2023-1-5")]
    declared = read_csv_strings(spark, p, ["order_id", "user_id", "order_date", "total_amount"])
    assert declared.columns[-1] == "total_amount"


def test_messages_omit_null_fields(spark):
    import json
    from sparkmart.sources.kafka import as_messages
    df = spark.createDataFrame([("U1", 5, None, True)], "user_id string, amount long, error_reason string, is_valid boolean")
    m = as_messages(df, "user_id").first()
    assert m["key"] == "U1"
    assert json.loads(m["value"]) == {"user_id": "U1", "amount": 5, "is_valid": True}
