"""Corpus queries with SQL, against that SQL on the whole check tables."""

from __future__ import annotations

import duckdb
import pytest

from tests.conftest import CHECK_FOLDER
from tests.test_oracle import TABLES, TYPES
from tidewatch.llm.queries import LLM_QUERIES, LLM_SQL


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{CHECK_FOLDER}/{table}.parquet'")
    result = LLM_QUERIES[name](spark, CHECK_FOLDER)
    columns = sorted(result.columns)
    cursor = connection.execute(LLM_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert {d[0]: str(d[1]) for d in cursor.description} == {n: TYPES[t] for n, t in result.dtypes}
    expected = sorted(tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall())
    assert expected
    assert sorted(tuple(row[c] for c in columns) for row in result.collect()) == expected
