"""Compare a query with its reference SQL, order of rows and columns aside."""

from __future__ import annotations

import glob
import math
import os
from decimal import Decimal

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, float):
        return ("float", "nan" if math.isnan(v) else v)
    if isinstance(v, Decimal):
        return ("decimal", str(v))
    return (type(v).__name__, v)


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(_value(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(shaped, key=repr)


def compare(df, con, sql: str) -> str | None:
    """None when both agree, else a short account of the first difference."""
    cursor = con.execute(sql)
    want_columns, want = _sorted([d[0] for d in cursor.description], cursor.fetchall())
    got_columns, got = _sorted(df.columns, [tuple(r) for r in df.collect()])
    if want_columns != got_columns:
        return f"columns {got_columns}, expected {want_columns}"
    if len(want) != len(got):
        return f"{len(got)} rows, expected {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"row {g}, expected {w}"
    return None
