"""Comparison of a query with its SQL, as bags of rows."""

import math
import os
from collections import Counter

import duckdb

DATA = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def database(folder=DATA):
    con = duckdb.connect()
    for t in os.listdir(folder):
        con.execute(f"create view {t.split('.')[0]} as select * from '{folder}/{t}'")
    return con


def same(spark, query, sql, folder=DATA):
    df = query(spark, folder)
    cols = sorted(df.columns)
    got = Counter(repr(tuple(norm(r[c]) for c in cols)) for r in df.collect())
    res = database(folder).execute(sql)
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = Counter(repr(tuple(norm(r[names.index(c)]) for c in cols)) for r in res.fetchall())
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])


def rows(df, *cols):
    return sorted((tuple(r[c] for c in (cols or df.columns)) for r in df.collect()), key=repr)
