"""Runs registered queries beside their SQL twins and compares all rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _value(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else (int(v) if v == int(v) else v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


SQL_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def type_gaps(df, con, sql: str) -> list[str]:
    """Columns whose type differs between the two sides."""
    theirs = {row[0]: row[1] for row in con.execute(f"describe {sql}").fetchall()}
    return [
        f"{name} {kind}/{theirs.get(name)}"
        for name, kind in df.dtypes
        if SQL_TYPES.get(kind) != theirs.get(name)
    ]


def compare(spark, con, fn, sql: str, sf_dir: str) -> str | None:
    """None where both sides agree, else what differs."""
    df = fn(spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if mine != theirs:
        left, right = mine - theirs, theirs - mine
        return (
            f"{sum(mine.values())} / {sum(theirs.values())} rows, {sum(left.values())} / "
            f"{sum(right.values())} differ: {sorted(map(str, left))[:2]} / {sorted(map(str, right))[:2]}"
        )
    if gaps := type_gaps(df, con, sql):
        return f"types {gaps}"
    return None if mine else "no rows"
