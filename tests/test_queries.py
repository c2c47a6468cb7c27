"""Every registered query against DuckDB on the same tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{SF_DIR}/{name}.parquet')")
    return connection


def _sortable(row):
    return [(v is None, str(type(v)), v) for v in row]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_duckdb(spark, duck, name):
    result = entry_point.queries()[name](spark, SF_DIR)
    oracle = duck.execute(entry_point.oracle_sql()[name])
    columns = [d[0] for d in oracle.description]
    assert sorted(columns) == sorted(result.columns)
    expected = sorted((tuple(r) for r in oracle.fetchall()), key=_sortable)
    got = sorted((tuple(r) for r in result.select(*columns).collect()), key=_sortable)
    assert len(got) > 0
    assert got == expected


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry_point.queries()) >= set(QUERIES)
    assert set(entry_point.queries()) >= set(entry_point.oracle_sql()) >= set(ORACLES)


def test_entry_runs(spark):
    result = entry_point.entry(spark)
    assert result.count() > 0
