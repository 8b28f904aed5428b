"""Compare Spark results with the oracle SQL, value by value and type by type."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return connection


def _plain(value: object) -> object:
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else ("f", value + 0.0)
    if isinstance(value, Decimal):
        return ("decimal", value)
    if isinstance(value, int):
        return ("i", value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value)


def _rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def difference(spark_df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal; otherwise what differs first."""
    result = connection.execute(sql)
    expected_columns = [d[0] for d in result.description]
    expected = _rows(expected_columns, result.fetchall())
    if sorted(expected_columns) != sorted(spark_df.columns):
        return f"columns: spark {sorted(spark_df.columns)} oracle {sorted(expected_columns)}"
    actual = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(actual) != len(expected):
        return f"rows: spark {len(actual)} oracle {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        names = sorted(spark_df.columns)
        a, e = wrong[0]
        cells = [(n, x, y) for n, x, y in zip(names, a, e) if x != y]
        return f"{len(wrong)} of {len(actual)} rows differ, first: {cells}"
    return None
