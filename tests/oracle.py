"""Comparison of a query with its SQL on the same tables."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)) and not hasattr(v, "asDict"):
        return tuple(plain(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(sorted((k, plain(x)) for k, x in v.asDict().items()))
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if type(v).__name__ == "Decimal":
        return round(float(v), 6)
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())


def sql_rows(sql, folder):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{folder}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    r = con.sql(sql)
    names = r.columns
    cols = sorted(names)
    at = [names.index(c) for c in cols]
    return cols, sorted(repr(tuple(plain(row[i]) for i in at)) for row in r.fetchall())
