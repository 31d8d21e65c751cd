import duckdb
import pytest
from telemetry_rows import SF

import __spark_entry__ as entry
from check_queries import TABLES, comparable
from fieldpulse.plans import catalog, oracles

QUERIES = catalog.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, oracle, name):
    got = comparable(QUERIES[name](spark, SF).toPandas())
    expected = comparable(oracle.execute(ORACLES[name]).df())
    assert list(got.columns) == list(expected.columns)
    assert got.equals(expected)
    assert len(got) > 0


def test_entry(spark):
    assert entry.entry(spark).columns == [
        "device_id", "metric_type", "window_start", "average", "p95", "count"]
