"""Compares a query with its SQL, in the way the driver does: columns by name, rows in any order."""

import datetime
import math
import os

import duckdb


def value(v):
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else str(int(v)) if v == int(v) and abs(v) < 1e15 else f"{v:.6g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str([value(x) for x in v]) if isinstance(v, (list, tuple)) else str(v)


def connection(folder):
    con = duckdb.connect()
    for f in os.listdir(folder):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{folder}/{f}')")
    return con


def compare(df, con, sql):
    cols = sorted(df.columns)
    got = sorted(tuple(value(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted(tuple(value(r[names.index(c)]) for c in cols) for r in cur.fetchall())
    assert got == want
