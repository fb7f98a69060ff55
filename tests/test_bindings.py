"""Every bound query against its SQL at the smallest scale, and the driver contract."""

import pytest

from bindings.registry import QUERIES
from oracle_check import compare, duck

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = contract.queries()[name](spark, sf)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, con, sql) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
