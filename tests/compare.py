"""Row-set comparison of a Spark frame with a DuckDB query."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

from loamflow.plans.queries import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    return value


def row_bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str:
    """Empty if both sides have the same columns and rows, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    ours, theirs = row_bag(df.columns, df.collect()), row_bag(names, result.fetchall())
    if ours == theirs:
        return ""
    return f"only Spark {list((ours - theirs).items())[:3]}, only SQL {list((theirs - ours).items())[:3]}"


def bag(df):
    """Rows as a sorted list, for comparing frames without caring about order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
