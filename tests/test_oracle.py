"""Every registered query against its SQL on the same files."""

import pytest

import __spark_entry__ as entry
import oracle

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf_dir, name):
    assert oracle.compare(spark, con, QUERIES[name], SQL.get(name), sf_dir) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
