"""Run a registered query and its DuckDB statement and compare the rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return round(value, 6) + 0.0
    return value


def table(columns, rows):
    """Columns in name order, and rows sorted whatever their types."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(lines, key=lambda r: [(v is None, str(v)) for v in r])


def from_spark(frame):
    return table(frame.columns, [tuple(r) for r in frame.collect()])


def from_duckdb(connection, statement):
    cursor = connection.execute(statement)
    return table([c[0] for c in cursor.description], cursor.fetchall())
