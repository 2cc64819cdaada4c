"""Every registered query against its DuckDB statement on the smallest driver tables."""

import compare
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_text.STATEMENTS


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_statement_belongs_to_a_query():
    assert set(entry._QUERIES) - set(ORACLE) == set() and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_statement(spark, con, key):
    assert compare.differences(QUERIES[key](spark, SF), con, ORACLE[key]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
