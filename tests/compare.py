"""Comparison of a query with its SQL counterpart over one data directory."""

import datetime
import glob
import math
import os

import duckdb
import numpy as np

DATA = os.environ.get("MILLRACE_TEST_DATA", "/root/testdata/sf0.001")


def connect(folder=DATA):
    c = duckdb.connect()
    for p in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(p)[: -len(".parquet")]
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(plain(x) for x in v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def assert_same(spark, con, query, sql, folder=DATA):
    df = query(spark, folder)
    columns = sorted(df.columns)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(plain(r[i]) for i in order) for r in result.fetchall()), key=repr)
    got = sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=repr)
    assert got == expected
