"""Every registered query against SQL in another engine."""

import pytest

import __spark_entry__ as contract
from compare import assert_same
from logspark.plans import catalog, oracle

QUERIES, SQL = catalog.QUERIES, oracle.oracle_sql()


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_check, name):
    rows = assert_same(QUERIES[name](spark, sf_check), sf_check, SQL[name])
    assert rows > 0
