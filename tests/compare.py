"""Run queries next to their SQL and compare the rows."""

from __future__ import annotations

import math
import time

import duckdb

from clausewise.plans.views import TABLES


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(x) for x in value)
    return value


def key(row):
    return tuple((x is not None, str(type(x)), str(x)) for x in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=key)


def compare(spark, con, sf_dir, query, sql):
    """Problem in words, or '' when equal; and the two times."""
    start = time.time()
    df = query(spark, sf_dir)
    mine = [tuple(row) for row in df.collect()]
    middle = time.time()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    times = (middle - start, time.time() - middle)
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(set(df.columns) ^ set(names))}", times
    if len(mine) != len(theirs):
        return f"{len(mine)} rows, SQL has {len(theirs)}", times
    a, b = rows_of(df.columns, mine), rows_of(names, theirs)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        columns = sorted(df.columns)
        x, y = bad[0]
        shown = [(c, p, r) for c, p, r in zip(columns, x, y) if p != r]
        return f"{len(bad)} of {len(a)} rows differ, first: {shown[:4]}", times
    return "", times
