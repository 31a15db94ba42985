"""Runs a registered query and its check SQL on the same tables and compares."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb

SF = "/root/testdata/sf0.001"


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day).isoformat()
    if isinstance(value, int):
        return value
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(_plain(r[i]) for i in order) for r in rows], key=repr), sorted(names)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    mine, my_names = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    other, other_names = rows_of(names, cursor.fetchall())
    if my_names != other_names:
        return f"columns {my_names} vs {other_names}"
    if len(mine) != len(other):
        return f"{len(mine)} rows vs {len(other)}; first mine {mine[:1]}, other {other[:1]}"
    for a, b in zip(mine, other):
        if a != b:
            return f"first difference\n  {a}\n  {b}"
    return None
