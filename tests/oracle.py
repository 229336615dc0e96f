"""Comparison of a DataFrame with DuckDB SQL on the same tables."""

import glob
import os

import duckdb


def sql_rows(sql, folder):
    con = duckdb.connect()
    for p in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con.sql(sql)


def assert_same(df, sql, folder):
    want = sql_rows(sql, folder)
    columns = sorted(df.columns)
    assert sorted(want.columns) == columns
    a = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    b = sorted(map(tuple, want.select(*columns).fetchall()), key=repr)
    assert len(a) == len(b)
    assert a == b
