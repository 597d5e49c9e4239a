"""Every registered query against its SQL on the sf0.01 tables."""

import pytest

import __spark_entry__
from terrier import registry
from compare import connect, difference

FOLDER = "/root/testdata/sf0.01"
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("key", QUERIES)
def test_query_agrees_with_sql(spark, con, key):
    assert difference(QUERIES[key](spark, FOLDER), con, ORACLES[key]) == ""


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0
