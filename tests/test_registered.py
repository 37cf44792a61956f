"""Every registered query against DuckDB on whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from compare import connect, duckdb_rows, spark_rows

FOLDER = "/root/testdata/sf0.001"
STATEMENTS = entry_points.oracle_queries.statements()
EXTRA = set(entry_points.llm.queries()) if entry_points.llm else set()
QUERIES = {k: v for k, v in entry_points.queries().items() if k not in EXTRA}


@pytest.fixture(scope="module")
def duckdb_tables():
    return connect(FOLDER)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_statement(spark, duckdb_tables, name):
    frame = QUERIES[name](spark, FOLDER)
    names, expected = duckdb_rows(duckdb_tables, STATEMENTS[name])
    assert sorted(frame.columns) == names
    assert spark_rows(frame) == expected


def test_entry_is_the_mart(spark):
    frame = entry_points.entry(spark)
    assert frame.count() > 0
