"""Side-by-side comparison of a Spark result with DuckDB on the same Parquet files."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    if isinstance(value, dt.datetime):
        return "datetime"
    if isinstance(value, dt.date):
        return "date"
    return type(value).__name__


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def difference(frame, con, sql: str) -> str | None:
    """None when both give the same rows, else what differs."""
    want = con.execute(sql)
    want_columns = [d[0] for d in want.description]
    if sorted(want_columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(want_columns)}"
    names = sorted(want_columns)
    place = [want_columns.index(n) for n in names]
    expected = [tuple(_plain(row[i]) for i in place) for row in want.fetchall()]
    got = [tuple(_plain(row[n]) for n in names) for row in frame.collect()]
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}"
    got.sort(key=repr)
    expected.sort(key=repr)
    for mine, theirs in zip(got, expected):
        if mine != theirs:
            return f"{names}: {mine} != {theirs}"
    for i, name in enumerate(names):
        mine = {_kind(r[i]) for r in got} - {"NoneType"}
        theirs = {_kind(r[i]) for r in expected} - {"NoneType"}
        if mine != theirs:
            return f"type of {name}: {mine} != {theirs}"
    return None
