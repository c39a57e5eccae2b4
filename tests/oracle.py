"""Side-by-side check of a registered query against its SQL."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return str(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark, con, name, function, sql, sf_dir):
    """(row count, first differences) — no differences means both agree."""
    df = function(spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return len(mine), [("columns", sorted(df.columns), sorted(names))]
    if mine == theirs:
        return len(mine), []
    left, right = set(mine), set(theirs)
    return len(mine), [
        ("counts", len(mine), len(theirs)), ("only spark", sorted(left - right)[:3]), ("only sql", sorted(right - left)[:3])
    ]
