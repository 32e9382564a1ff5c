"""Every registered query against its SQL, on the whole tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidewatch.registry import QUERIES
from tests.conftest import CHECK_FOLDER

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{CHECK_FOLDER}/{table}.parquet'")
    return connection


def _normal(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = queries()[name](spark, CHECK_FOLDER)
    columns = sorted(result.columns)
    actual = [tuple(_normal(row[c]) for c in columns) for row in result.collect()]
    cursor = duck.execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert {n: str(d[1]) for n, d in zip(names, cursor.description)} == {
        n: TYPES[t] for n, t in result.dtypes
    }
    order = [names.index(c) for c in columns]
    expected = [tuple(_normal(row[i]) for i in order) for row in cursor.fetchall()]
    assert actual, "a check on no rows shows nothing"
    assert _sorted(actual) == _sorted(expected)


def test_ordered_report_is_in_order(spark):
    rows = [(r["date"], r["device_type"]) for r in queries()["q1_p95_from_events"](spark, CHECK_FOLDER).collect()]
    assert rows == sorted(rows)


def test_entry(spark):
    result = entry(spark)
    assert result.columns == [
        "device_type", "date", "p95_duration", "total_events", "avg_duration", "mean_duration", "stddev_duration"
    ]
    assert result.count() == 111
