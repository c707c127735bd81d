"""Compares a query with its SQL in DuckDB, whatever the order of rows."""

import os
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, Decimal):
        return str(v)
    return str([plain(x) for x in v]) if isinstance(v, (list, tuple)) else str(v)


def check(df, connection, sql):
    names = sorted(df.columns)
    found = connection.execute(sql)
    own = [d[0] for d in found.description]
    assert sorted(own) == names
    want = sorted(tuple(plain(r[own.index(n)]) for n in names) for r in found.fetchall())
    got = sorted(tuple(plain(r[n]) for n in names) for r in df.collect())
    assert got, "a query without rows proves nothing"
    assert len(got) == len(want)
    assert got == want
