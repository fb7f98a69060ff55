"""Bound queries with SQL against DuckDB, over whole tables."""

import pytest
from oracle_check import compare, duck

from evidence.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, sf, name):
    assert compare(queries.QUERIES[name](spark, sf), duck(sf), queries.SQL[name]) is None


def test_every_operator_is_bound():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, len(queries.QUERIES) + 1))
