"""Every registered query against its SQL, on the smallest given tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from stockglass.plans.oracle import ORACLE_SQL
from stockglass.plans.registry import QUERIES

DATA = entry_points.SMOKE_DIR
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, DATA)
    got = [tuple(r) for r in df.collect()]
    cursor = duck.execute(entry_points.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    places = [columns.index(c) for c in df.columns]
    wanted = [tuple(r[i] for i in places) for r in cursor.fetchall()]
    assert got and sorted(map(repr, got)) == sorted(map(repr, wanted))


def test_entry(spark):
    assert entry_points.entry(spark).limit(1).count() == 1
