"""Spark-vs-DuckDB comparison used by the tests (and handy by hand).

Both results become lists of normalised tuples over the sorted column names;
floats are rounded, dates and timestamps printed in ISO form, and the
multisets compared.
"""
from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

VIEWS = ("region nation customer supplier part orders lineitem events documents "
         "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day).isoformat(sep=" ")
    if isinstance(v, bool):
        return int(v)
    return v


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    import os
    for t in VIEWS:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.isdir(path):
            path = f"{path}/*.parquet"
        elif not os.path.exists(path):
            continue
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)


def rows_of_duck(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    data = rel.fetchall()
    return [names[i] for i in order], sorted(
        (tuple(_norm(r[i]) for i in order) for r in data), key=repr)


def compare(df, con, sql):
    sc, sr = rows_of_spark(df)
    dc, dr = rows_of_duck(con, sql)
    if sc != dc:
        return False, f"columns differ: {sc} vs {dc}"
    if len(sr) != len(dr):
        return False, f"row counts differ: {len(sr)} vs {len(dr)}"
    if sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        return False, f"values differ, e.g. {diff}"
    return True, f"{len(sr)} rows"
