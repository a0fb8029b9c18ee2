"""Registered queries against their SQL on the smallest test tables."""

import os

import pytest

from tests import compare

FOLDER = "/root/testdata/sf0.001"
SQL = compare.registered.oracle_sql()
ROWS_ONLY = sorted(set(compare.registered.queries()) - set(SQL))

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def connection():
    return compare.sql_connection(FOLDER)


def test_all_sql_has_a_query():
    assert set(SQL) <= set(compare.registered.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, connection, name):
    assert compare.difference(spark, connection, FOLDER, name) is None


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_query_has_rows(spark, name):
    assert compare.registered.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert compare.registered.entry(spark).count() == 20
