"""Compare a query's rows with those of its SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, (Decimal, float)):
        number = float(value)
        return "nan" if math.isnan(number) else f"f{number:.6f}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _kind(value) -> str:
    return type(value).__name__


def difference(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same columns and the same rows, in any order."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} but {sorted(names)} expected"
    if len(set(names)) != len(names):
        return f"repeated column in {names}"
    order = sorted(names)
    expected = Counter(tuple(_plain(r[names.index(n)]) for n in order) for r in cursor.fetchall())
    rows = df.select(*order).collect()
    found = Counter(tuple(_plain(v) for v in r) for r in rows)
    if found == expected:
        return None
    return (
        f"{sum(found.values())} rows, {sum(expected.values())} expected; "
        f"only found {list((found - expected).items())[:3]}, only expected {list((expected - found).items())[:3]}"
    )
