"""Every registered query against its SQL, on the small tables."""

import duckdb
import pytest
from small_tables import SF

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def rows(values):
    return sorted(values, key=lambda row: [(v is None, str(v)) for v in row])


OWN = [name for group in entry.GROUPS for name in group.QUERIES]


def test_every_query_has_sql():
    assert set(OWN) <= entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry(spark):
    assert entry.entry(spark).columns == ["id", "n"]


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, database, name):
    found = entry.queries()[name](spark, SF)
    expected = database.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(columns) == sorted(found.columns)
    assert rows(map(tuple, found.select(columns).collect())) == rows(expected.fetchall())
