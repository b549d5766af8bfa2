"""Every registered query against its SQL, on the generated tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_point

duckdb = pytest.importorskip("duckdb")
SF_DIR = Path("/root/testdata/sf0.001")
TABLES = ["documents", "pages", "benchmark"]

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no generated tables")


def nulls_first(row):
    return [(x is not None, x) for x in row]


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(entry_point.search_queries()) == set(entry_point.search_sql())


def test_entry(spark):
    found = entry_point.entry(spark)
    assert found.columns == ["rank", "doc_id", "score"]
    assert found.count() == 10


@pytest.mark.parametrize("name", list(entry_point.search_queries()))
def test_query_equals_sql(spark, database, name):
    frame = entry_point.queries()[name](spark, str(SF_DIR))
    columns = sorted(frame.columns)
    found = sorted((tuple(row) for row in frame.select(*columns).collect()), key=nulls_first)
    sql = f"SELECT {', '.join(columns)} FROM ({entry_point.oracle_sql()[name]})"
    expected = sorted(database.execute(sql).fetchall(), key=nulls_first)
    assert found == expected
    assert found


@pytest.mark.parametrize("name", list(entry_point.vector_queries()))
def test_vector_queries_run(spark, name):
    rows = entry_point.queries()[name](spark, str(SF_DIR)).collect()
    assert rows and name not in entry_point.oracle_sql()
