"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as registered

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_all_queries_have_an_oracle():
    assert set(registered.QUERIES) == set(registered.ORACLES)


@pytest.mark.parametrize("name", registered.QUERIES)
def test_query(spark, duck, name):
    df = registered.queries()[name](spark, SF_DIR)
    found = duck.execute(registered.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    want = [tuple(dict(zip(names, row))[c] for c in df.columns) for row in found.fetchall()]
    got = [tuple(row) for row in df.collect()]
    assert len(got) > 0
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_entry(spark):
    df = registered.entry(spark)
    assert df.columns[:4] == ["dim_team_key", "team_name", "season", "competition"]
    assert df.count() > 0
