"""Run a query and its SQL twin and compare schemas, row counts and values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value, digits: int | None):
    if isinstance(value, bool) or value is None or isinstance(value, (str, int)):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, digits) if digits is not None else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return str(value) if not isinstance(value, (list, tuple)) else tuple(plain(v, digits) for v in value)


def table(columns, rows, digits):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i], digits) for i in order) for r in rows)


def compare(df, con, sql: str, digits: int | None = None) -> str | None:
    """None when equal, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want_cols, want = table(names, cursor.fetchall(), digits)
    got_cols, got = table(df.columns, [tuple(r) for r in df.collect()], digits)
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got == want:
        return None
    only_got, only_want = got - want, want - got
    return (
        f"rows {sum(got.values())} vs {sum(want.values())}; only spark {sum(only_got.values())}: {list(only_got)[:2]}; "
        f"only sql {sum(only_want.values())}: {list(only_want)[:2]}"
    )
