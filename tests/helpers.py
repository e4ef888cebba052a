"""Comparison of Spark's and DuckDB's rows."""

import glob
import math
import os

import duckdb


def plain(x):
    if x is None or isinstance(x, (bool, str)):
        return x
    if isinstance(x, float):
        return None if math.isnan(x) else int(x) if x == int(x) and abs(x) < 1e15 else float(f"{x:.9g}")
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    if isinstance(x, (bytes, bytearray)):
        return bytes(x)
    return int(x) if hasattr(x, "__int__") and not isinstance(x, int) and float(x) == int(x) else float(x) if not isinstance(x, int) else x


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)


def duck_rows(sql, sf):
    c = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    r = c.execute(sql)
    names = [d[0] for d in r.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted((tuple(plain(row[i]) for i in order) for row in r.fetchall()), key=repr)
