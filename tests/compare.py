"""Order-insensitive comparison of a Spark result with its SQL oracle."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def oracle_connection(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(directory).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value: object) -> object:
    if isinstance(value, bool) or value is None or isinstance(value, (int, str, dt.date)):
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return repr(value)


def bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, otherwise a short description."""
    rows = [tuple(r) for r in spark_df.collect()]
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(spark_df.columns) != sorted(columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(columns)}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows, oracle has {len(expected)}"
    ours, theirs = bag(spark_df.columns, rows), bag(columns, expected)
    if ours == theirs:
        return None
    extra, missing = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
    return f"{sorted(columns)}: {sum((ours - theirs).values())} differ, ours {extra} oracle {missing}"[:1500]
