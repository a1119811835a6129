"""Run a registered query and its SQL twin and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark, con, sf_dir, fn, sql):
    """Empty text if both sides give the same rows, else what differs."""
    df = fn(spark, sf_dir)
    left = canonical(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    right = canonical([c[0] for c in cur.description], cur.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} <> {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} <> {len(right[1])}; {left[1][:2]} / {right[1][:2]}"
    bad = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if bad:
        return f"{len(bad)} of {len(left[1])} rows differ, e.g. {bad[0][0]} <> {bad[0][1]}"
    return "" if left[1] else "no rows on either side"
