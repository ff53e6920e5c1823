"""Holds queries against their SQL in DuckDB: names, row counts and values, in any order of rows."""

from __future__ import annotations

import datetime
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        if os.path.exists(path := f"{sf_dir}/{t}.parquet"):
            con.execute(f"create view {t} as select * from read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, bool) or x is None or isinstance(x, str):
        return x
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, datetime.date):
        return x.isoformat()
    if isinstance(x, (list, tuple)):
        return tuple(plain(y) for y in x)
    try:
        return float(f"{float(x):.9g}")
    except (TypeError, ValueError):
        return x


def differences(df, con, sql: str) -> str:
    rows = df.collect()
    found = con.execute(sql)
    names = [x[0] for x in found.description]
    wanted = found.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    order = [df.columns.index(x) for x in sorted(names)]
    mine = sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)
    order = [names.index(x) for x in sorted(names)]
    theirs = sorted((tuple(plain(r[i]) for i in order) for r in wanted), key=repr)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    for a, b in zip(mine, theirs, strict=True):
        if a != b:
            return f"{a} against {b}"
    return ""
