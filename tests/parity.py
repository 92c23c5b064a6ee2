"""Compares a query with its SQL, row by row and without order."""

from __future__ import annotations

import decimal
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for name in sorted(os.listdir(folder)):
        path = f"{folder}/{name}"
        c.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return c


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.8g}")
    if isinstance(v, dict):
        return tuple(plain(x) for x in v.values())
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def compare(query, sql: str, spark, folder: str) -> None:
    df = query(spark, folder)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=str)
    result = connect(folder).execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == names
    want = sorted((tuple(plain(r[columns.index(n)]) for n in names) for r in result.fetchall()), key=str)
    assert len(got) == len(want)
    assert got == want
