"""Run a registered query and its SQL equivalent and compare them row by row."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, bool) or value is None:
        return value
    return float(value) if isinstance(value, int) else str(value)


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cells, key=repr)


def compare(spark, con, fn, sql, sf_dir) -> str | None:
    """None where both agree, else a short description of the first difference."""
    df = fn(spark, sf_dir)
    ours = _table(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    theirs = _table([d[0] for d in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return f"columns differ: {ours[0]} / {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows / {len(theirs[1])} rows"
    for a, b in zip(ours[1], theirs[1]):
        if a != b:
            return f"first difference: {a} / {b}"
    return None
