"""Runs named queries beside their oracle statements and compares whole results."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("num", format(value.normalize(), "f"))
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return ("num", str(value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else ("float", float(f"{value:.12g}"))
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark_df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs."""
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    expected = rows_of(names, cursor.fetchall())
    got = rows_of(spark_df.columns, spark_df.collect())
    if got == expected:
        return None
    extra, lacking = list((got - expected).items())[:3], list((expected - got).items())[:3]
    return (
        f"{sum(got.values())} rows, expected {sum(expected.values())}; columns {sorted(names)}; "
        f"unexpected {extra}; missing {lacking}"
    )
