"""Kafka-shaped transaction messages for tests."""
import datetime as dt
import json

T0 = dt.datetime(2025, 3, 6, 12, 0, 0)
SCHEMA = "key string, value string, topic string, partition int, offset long, timestamp timestamp"


def iso(t):
    return t.strftime("%Y-%m-%dT%H:%M:%SZ")


def msg(offset, record_time, user="U1000", amount=5000, ts=None, source="mobile", raw=None):
    if raw is None:
        body = {"user_id": user, "amount": amount,
                "timestamp": iso(record_time) if ts is None else ts, "source": source}
        raw = json.dumps(body)
    return (None, raw, "transactions", 0, offset, record_time)
