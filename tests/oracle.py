"""Comparison of a query with its SQL in DuckDB."""

import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for f in sorted(os.listdir(sf_dir)):
        p = os.path.join(sf_dir, f)
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(round(v, 6) + 0.0)
    if v is None or v is pd.NaT:
        return "null"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(plain(x) for x in v) + "]"
    return repr(v)


def rows_of(columns, rows):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(plain(r[i]) for i in at) for r in rows)


def assert_same(df, con, sql):
    r = con.execute(sql)
    names = [x[0] for x in r.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(x) for x in df.collect()]) == rows_of(names, r.fetchall())
