"""Every registered query against its SQL in DuckDB."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_queries import compare, connect  # noqa: E402
from tidelog.plans import catalog  # noqa: E402

# The optional operators have their own tests beside them.
QUERIES = {name: fn for name, fn in entry.queries().items() if name in catalog.QUERIES}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in catalog.QUERIES}


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    got = QUERIES[name](spark, sf).toArrow()
    assert got.num_rows > 0
    if name in SQL:
        assert compare(got, duck.execute(SQL[name]).to_arrow_table()) == []
