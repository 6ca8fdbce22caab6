"""Every query with an expected result, compared on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import connect, difference
from checks.queries import QUERIES

from conftest import SF_DIR

STATEMENTS = oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_statement_has_a_query():
    assert set(STATEMENTS) <= set(queries())
    assert set(QUERIES) <= set(STATEMENTS)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query(spark, db, name):
    assert difference(queries()[name](spark, SF_DIR), db, STATEMENTS[name]) is None
