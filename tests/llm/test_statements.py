from __future__ import annotations

import pytest
from compare import connect, from_duckdb, from_spark

from cohortry.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_statement(spark, small, name):
    rows = from_spark(QUERIES[name](spark, small))
    assert rows == from_duckdb(connect(small), ORACLES[name]) and rows[1]
