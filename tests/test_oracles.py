"""Every registered query against its DuckDB statement."""

import pytest
from compare import connect, from_duckdb, from_spark

import __spark_entry__ as registry
from oracles import ORACLES

QUERIES, STATEMENTS = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


# The corpus operators and their statements have tests of their own.
REPORTS = sorted(ORACLES)


def test_every_report_has_a_statement():
    corpus = {name for name in QUERIES if name.startswith("op") or name == "pipeline"}
    assert set(QUERIES) - corpus == set(REPORTS)
    assert set(REPORTS) <= set(STATEMENTS)


@pytest.mark.parametrize("name", REPORTS)
def test_query_equals_its_statement(spark, duck, folder, name):
    columns, rows = from_spark(QUERIES[name](spark, folder))
    expected_columns, expected = from_duckdb(duck, STATEMENTS[name])
    assert columns == expected_columns
    assert rows == expected
    assert rows


def test_entry_runs(spark):
    assert registry.entry(spark).count() > 0
