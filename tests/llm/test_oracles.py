"""The operators' queries against their SQL on the same tables."""

import os

import duckdb
import pytest

from tests.test_queries import TABLES, _sortable
from tidemark.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{SF_DIR}/{name}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_duckdb(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    oracle = duck.execute(ORACLES[name])
    columns = [d[0] for d in oracle.description]
    assert sorted(columns) == sorted(result.columns)
    expected = sorted((tuple(r) for r in oracle.fetchall()), key=_sortable)
    got = sorted((tuple(r) for r in result.select(*columns).collect()), key=_sortable)
    assert len(got) > 0
    assert got == expected
