"""Compares a query's rows with those of its SQL in DuckDB."""

import math
import numbers

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19]
    if isinstance(v, bool) or not isinstance(v, numbers.Number):
        return str(v)
    return str(int(v)) if isinstance(v, numbers.Integral) else f"{float(v):.9g}"


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


def assert_same(df, sql, c):
    want = c.sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())
