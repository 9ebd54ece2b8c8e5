"""Every registered query against the SQL that defines it."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_definition():
    assert entry.CHECKS.keys() == entry.QUERIES.keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF_DIR, name, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_flagship(spark):
    assert entry.entry(spark).count() == 1
