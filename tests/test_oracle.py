"""Every registered query against its DuckDB statement."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as contract
from loyaltylens.catalog import registered
from oracle.sql import statements

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
QUERIES, SQL = registered(), statements()
REPORTS = [name for name in QUERIES if name.startswith(("scorecard", "penetration", "member_", "lbs", "kpi", "sales"))]
OUTPUT_TYPES = {"string", "bigint", "double", "date"}


@pytest.fixture(scope="module")
def small():
    return compare.connect(SMALL)


@pytest.fixture(scope="module")
def medium():
    return compare.connect(MEDIUM)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_small_tables(spark, small, name):
    result = QUERIES[name](spark, SMALL)
    assert {f.dataType.simpleString() for f in result.schema.fields} <= OUTPUT_TYPES
    assert compare.difference(result, small, SQL[name]) is None


@pytest.mark.parametrize("name", REPORTS)
def test_medium_tables(spark, medium, name):
    assert compare.difference(QUERIES[name](spark, MEDIUM), medium, SQL[name]) is None


def test_flagship_query(spark):
    assert contract.entry(spark).count() > 0
