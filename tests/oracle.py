"""Compares a query with its SQL on the same tables, as rows in any order."""

import glob
import math
import os

import duckdb


def connect(d):
    con = duckdb.connect()
    for p in glob.glob(f"{d}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def plain(x):
    if hasattr(x, "tolist") and not isinstance(x, (int, float)):
        x = x.tolist()
    if isinstance(x, (list, tuple)):
        return tuple(plain(y) for y in x)
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    return x


def rows(columns, table):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in table), key=repr)


def compare(spark, d, queries, sql, name):
    got = queries[name](spark, d)
    rel = connect(d).sql(sql[name])
    assert sorted(got.columns) == sorted(rel.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(rel.columns, rel.fetchall())
