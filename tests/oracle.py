"""Runs a registered query and its SQL on the same Parquet files and compares the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def differences(df, connection, sql) -> str | None:
    """None if equal, else a short account of the first difference."""
    result = connection.execute(sql)
    sql_columns = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(df.columns) != sorted(sql_columns):
        return f"columns {sorted(df.columns)} against {sorted(sql_columns)}"
    got = _ordered(df.columns, [tuple(r) for r in df.collect()])
    want = _ordered(sql_columns, expected)
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs or [type(v) for v in mine] != [type(v) for v in theirs]:
            return f"{mine} against {theirs}"
    return None
