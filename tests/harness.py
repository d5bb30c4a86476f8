"""Compare registered queries with their SQL on the same parquet files."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v + 0.0
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr), sorted(names)


def compare(spark, sf_dir, name, fn, sql, con=None):
    """(ok, message) for one query; `sql` None only checks that the query runs."""
    began = time.time()
    df = fn(spark, sf_dir)
    got_names = df.columns
    got = [tuple(r) for r in df.collect()]
    spent = time.time() - began
    if sql is None:
        return len(got) > 0, f"rows={len(got)} {spent:.1f}s"
    began = time.time()
    cur = (con or duck(sf_dir)).execute(sql)
    want_names = [d[0] for d in cur.description]
    want = cur.fetchall()
    sql_spent = time.time() - began
    a, an = _rows(got_names, got)
    b, bn = _rows(want_names, want)
    if an != bn:
        return False, f"columns differ: {an} vs {bn}"
    if len(a) != len(b):
        return False, f"row counts differ: {len(a)} vs {len(b)}"
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        return False, f"{len(diff)} of {len(a)} rows differ, e.g. {diff[0][0]} vs {diff[0][1]}"
    return True, f"rows={len(a)} {spent:.1f}s sql={sql_spent:.1f}s types={df.dtypes}"
