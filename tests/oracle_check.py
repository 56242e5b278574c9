"""Runs registered queries beside their SQL and says where they differ."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, float):
        return repr(value + 0.0)
    return f"{type(value).__name__}:{value}"


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, connection, sql) -> str | None:
    """None where both give the same rows in whatever order."""
    ours = _table(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(sql)
    theirs = _table([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} against {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows against {len(theirs[1])}"
    wrong = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    return f"{len(wrong)} rows differ, such as {wrong[0]}" if wrong else None
