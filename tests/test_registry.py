"""Every registered query against its SQL."""

import pytest

from quarrysql import registry
from quarrysql.checks.compare import connect, difference

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_check_has_a_query():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf, name):
    found, rows, _ = difference(spark, con, sf, QUERIES[name], SQL.get(name))
    assert found is None
    assert rows > 0


def test_entry(spark):
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert rows and set(entry.oracle_sql()) <= set(entry.queries())
