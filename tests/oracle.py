"""Compare registered queries with their SQL on the same tables."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(_plain(r[i]) for i in order) for r in rows], key=repr)


def compare(spark, con, build, sql, folder):
    """(number of rows, None) when equal, else (number of rows, what differs)."""
    df = build(spark, folder)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = rows_of(names, cur.fetchall())
    if mine[0] != theirs[0]:
        return len(mine[1]), f"columns {mine[0]} / {theirs[0]}"
    if mine[1] == theirs[1]:
        kinds = {type(v) for r in mine[1][:50] for v in r} ^ {type(v) for r in theirs[1][:50] for v in r}
        return len(mine[1]), f"types {kinds}" if kinds else None
    a, b = set(mine[1]), set(theirs[1])
    only_a, only_b = sorted(a - b, key=repr)[:2], sorted(b - a, key=repr)[:2]
    return len(mine[1]), f"rows {len(mine[1])} / {len(theirs[1])}: {str(only_a)[:600]} / {str(only_b)[:600]}"
