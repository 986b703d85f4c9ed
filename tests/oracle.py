"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import datetime as dt
import glob
import os
from decimal import Decimal

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, (int, float, Decimal)):
        return "float" if isinstance(value, float) else ("decimal" if isinstance(value, Decimal) else "int")
    return type(value).__name__


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def _cell(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def compare(spark, con, build, sql: str, sf_dir: str) -> str | None:
    """None when both give the same rows, otherwise what differs."""
    df = build(spark, sf_dir)
    cur = con.execute(sql)
    theirs_cols = [d[0] for d in cur.description]
    theirs = cur.fetchall()
    ours = [tuple(r) for r in df.collect()]
    if sorted(df.columns) != sorted(theirs_cols):
        return f"columns differ: {sorted(set(df.columns) ^ set(theirs_cols))}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, oracle has {len(theirs)}"
    if not ours:
        return "no rows to compare"
    for name in df.columns:
        a = {kind(r[df.columns.index(name)]) for r in ours} - {"NoneType"}
        b = {kind(r[theirs_cols.index(name)]) for r in theirs} - {"NoneType"}
        if a != b:
            return f"{name}: {a} against {b}"
    left, right = canonical(ours, df.columns), canonical(theirs, theirs_cols)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        names = sorted(df.columns)
        a, b = wrong[0]
        cells = [(c, x, y) for c, x, y in zip(names, a, b) if x != y]
        return f"{len(wrong)} rows differ, first: {cells[:4]}"
    return None
