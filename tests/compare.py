"""Rows of a query and of its SQL in DuckDB, made comparable."""

import os

import duckdb


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(df):
    cols = sorted(df.columns)
    return cols, sorted(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())


def duckdb_rows(sql, sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.sql(f"create view {name.split('.')[0]} as select * from '{sf_dir}/{name}'")
    got = con.sql(sql)
    cols = sorted(got.columns)
    at = [got.columns.index(c) for c in cols]
    return cols, sorted(repr(tuple(plain(r[i]) for i in at)) for r in got.fetchall())
