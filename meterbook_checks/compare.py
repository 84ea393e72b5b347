"""Compare a Spark result with its DuckDB counterpart, value by value."""

from __future__ import annotations

import datetime as dt
import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, Decimal)):
        return f"{Decimal(str(value)):.4f}"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value)


def as_bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(columns, rows, con, sql) -> str:
    """Empty when both sides hold the same rows."""
    found = con.execute(sql)
    other_columns = [d[0] for d in found.description]
    other_rows = found.fetchall()
    if sorted(c.lower() for c in columns) != sorted(c.lower() for c in other_columns):
        return f"columns {sorted(columns)} / {sorted(other_columns)}"
    mine, other = as_bag(columns, rows), as_bag(other_columns, other_rows)
    if mine == other:
        return ""
    only_mine, only_other = mine - other, other - mine
    return (
        f"rows {len(rows)} / {len(other_rows)}; only here {sum(only_mine.values())}: {list(only_mine)[:2]}; "
        f"only there {sum(only_other.values())}: {list(only_other)[:2]}"
    )
