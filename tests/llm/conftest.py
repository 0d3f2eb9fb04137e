import os
import sys

import duckdb
import pytest

for place in ("../../tools", "../..", "."):
    sys.path.insert(0, os.path.abspath(os.path.join(os.path.dirname(__file__), place)))

from tidelog.llm.common import prepare  # noqa: E402


@pytest.fixture(scope="session")
def lspark(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con
