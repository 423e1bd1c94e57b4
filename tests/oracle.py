"""Run a query on Spark and its SQL on DuckDB and compare whole results."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf}/{t}.parquet").exists():
            con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def kinds(names, types):
    """Coarse column types, by column name."""
    groups = {
        "bigint": "integer", "int": "integer", "integer": "integer", "hugeint": "integer", "double": "double",
        "string": "text", "varchar": "text", "date": "date", "boolean": "boolean",
    }
    return {n: groups.get(str(t).lower(), str(t).lower()) for n, t in zip(names, types)}


def compare(df, con, sql: str) -> str | None:
    """None when rows, columns and types agree; otherwise what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = [d[1] for d in result.description]
    want_columns, want = _rows(names, result.fetchall())
    got_columns, got = _rows(df.columns, df.collect())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    got_kinds, want_kinds = kinds(*zip(*df.dtypes)), kinds(names, types)
    if got_kinds != want_kinds:
        return f"types {({c: (got_kinds[c], want_kinds[c]) for c in got_kinds if got_kinds[c] != want_kinds[c]})}"
    if got != want:
        extra, lacking = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"{sum(got.values())} rows, expected {sum(want.values())}; extra {extra}; lacking {lacking}"
    return None
