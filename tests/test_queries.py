"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from poolweave.catalog import ORACLES, QUERIES

TABLES = "/root/testdata/sf0.001"
NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{name}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    df = entry.queries()[name](spark, TABLES)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    answer = database.execute(entry.oracle_sql()[name])
    order = [c[0] for c in answer.description]
    assert sorted(order) == columns
    expected = [tuple(r[order.index(c)] for c in columns) for r in answer.fetchall()]
    assert got == sorted(expected, key=repr)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
