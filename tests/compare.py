"""Order-insensitive comparison of a Spark result with an SQL result."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _kind(value):
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    if isinstance(value, dt.datetime):
        return "timestamp"
    if isinstance(value, dt.date):
        return "date"
    return type(value).__name__


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(columns), sorted(picked, key=repr)


def difference(spark_frame, con, sql: str) -> str | None:
    got_columns, got = rows_of(spark_frame.columns, [tuple(r) for r in spark_frame.collect()])
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want_columns, want = rows_of(columns, result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b or [_kind(v) for v in a] != [_kind(v) for v in b]:
            return f"{a} != {b}"
        if any(isinstance(v, Decimal) for v in a):
            return f"decimal in the result: {a}"
    return None
