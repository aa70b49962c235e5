"""Side-by-side comparison of a registered query with its reference SQL."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(folder, f"{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if hasattr(value, "as_tuple"):
        return round(float(value), 6)
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def difference(frame, connection, sql: str, rows=None) -> str | None:
    """None when both agree; otherwise what differs."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    want_columns, want = _sorted_rows(names, cursor.fetchall())
    rows = frame.collect() if rows is None else rows
    have_columns, have = _sorted_rows(frame.columns, [tuple(r) for r in rows])
    if have_columns != want_columns:
        return f"columns {have_columns} != {want_columns}"
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}
    for name, kind in frame.dtypes:
        if kinds.get(types[name]) != kind:
            return f"type of {name}: {kind} != {types[name]}"
    if len(have) != len(want):
        return f"{len(have)} rows != {len(want)}; only here {list(set(have) - set(want))[:2]}, only there {list(set(want) - set(have))[:2]}"
    for a, b in zip(have, want):
        if a != b:
            bad = [(c, x, y) for c, x, y in zip(have_columns, a, b) if x != y]
            return f"rows differ: {str(bad)[:600]}"
    return None
