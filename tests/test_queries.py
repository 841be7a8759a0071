"""Every registered query against SQL over the same tables."""

import pytest

import __spark_entry__ as contract
from compare import oracle_rows, rows_of

SF_DIR = contract.SMOKE_DIR


def test_every_query_has_sql():
    assert contract.own_queries().keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", contract.own_queries())
def test_query_equals_sql(spark, name):
    result = contract.own_queries()[name](spark, SF_DIR)
    names, expected = oracle_rows(contract.oracle_sql()[name], SF_DIR)
    assert sorted(result.columns) == names
    assert rows_of(result) == expected


def test_entry(spark):
    result = contract.entry(spark)
    assert len(result.columns) == 33
    assert result.count() > 0
