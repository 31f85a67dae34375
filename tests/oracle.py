"""Side-by-side comparison of a Spark query with its DuckDB oracle."""

from __future__ import annotations

from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

Rows = tuple[list[str], list[tuple]]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def spark_rows(df: DataFrame) -> Rows:
    return df.columns, [tuple(row) for row in df.collect()]


def duck_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> Rows:
    result = connection.execute(sql)
    return [item[0] for item in result.description], result.fetchall()


def normal(rows: Rows) -> list[tuple]:
    """Columns by name, cells with their Python type and exact value, rows in order."""
    names, cells = rows
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(f"{type(row[i]).__name__}:{row[i]!r}" for i in order) for row in cells)


def difference(left: Rows, right: Rows) -> str:
    """Empty text if both hold the same columns and rows, else a short account."""
    if sorted(left[0]) != sorted(right[0]):
        return f"columns {sorted(left[0])} != {sorted(right[0])}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows != {len(right[1])} rows"
    a, b = normal(left), normal(right)
    pairs = [(x, y) for x, y in zip(a, b) if x != y]
    if not pairs:
        return ""
    fields = [f"{n}: {x} | {y}" for n, x, y in zip(sorted(left[0]), *pairs[0]) if x != y]
    return f"{len(pairs)} rows differ, first: {pairs[0]}\n   " + "\n   ".join(fields)
