"""Queries that SQL can state, against DuckDB."""
import pytest

import __spark_entry__ as E
from compare import compare, duck
from sparkmart.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf, name):
    ok, message = compare(QUERIES[name](spark, sf), duck(sf), ORACLES[name])
    assert ok, message


def test_all_operators_are_registered():
    assert set(QUERIES) <= set(E.queries())
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")} == set(range(1, 14)) and "pipeline" in QUERIES
