"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as registered
from agreement import differences, open_tables
from tidegate.plans import catalog

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = catalog.QUERIES
ORACLES = catalog.ORACLES


@pytest.fixture(scope="module")
def tables():
    return open_tables(FOLDER)


def test_each_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(registered.oracle_sql()) <= set(registered.queries())
    assert set(QUERIES) <= set(registered.queries())


def test_entry_has_rows(spark):
    df = registered.entry(spark)
    assert df.columns[:4] == ["ORDER_ID", "CUSTOMER_ID", "ORDER_DATE", "ORDER_AMOUNT"]
    assert not df.isEmpty()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    if name in ORACLES:
        assert differences(spark, tables, QUERIES[name], ORACLES[name], FOLDER) == []
    else:
        assert QUERIES[name](spark, FOLDER).count() > 0
