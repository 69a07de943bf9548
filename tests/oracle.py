"""Compare registered queries with their SQL in DuckDB: columns, row count and values."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
    return con


def _plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def differences(df, con, sql: str, limit: int = 3) -> list[str]:
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_names, want = _rows([c[0] for c in cur.description], cur.fetchall())
    if got_names != want_names:
        return [f"columns {got_names} != {want_names}"]
    if len(got) != len(want):
        return [f"{len(got)} rows, expected {len(want)}"]
    return [f"{g} != {w}" for g, w in zip(got, want) if g != w][:limit]
