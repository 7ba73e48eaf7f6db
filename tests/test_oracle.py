"""Registered queries against SQL over the same tables."""

from __future__ import annotations

import pathlib

import pytest

import __spark_entry__ as contract
from compare import connect, spark_rows, sql_rows

SF_DIR = pathlib.Path("/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def connection():
    if not SF_DIR.exists():
        pytest.skip("test tables are not here")
    return connect(str(SF_DIR))


NAMES = [query.__name__ for query in contract._QUERIES]


def test_every_query_has_sql():
    assert set(NAMES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, connection, name):
    columns, rows = spark_rows(contract.queries()[name](spark, str(SF_DIR)))
    expected_columns, expected = sql_rows(connection, contract.oracle_sql()[name])
    assert columns == expected_columns
    assert sum(expected.values()) > 0
    assert rows - expected == expected - rows


def test_entry(spark):
    report = contract.entry(spark)
    assert report.columns == ["date", "currency_symbol", "transactions", "total_usd_volume"]
    assert report.count() > 0
