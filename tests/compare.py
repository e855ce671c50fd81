"""Rows of a Spark frame and of a DuckDB statement in one comparable form."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
from collections import Counter

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return "nan" if math.isnan(value) else f"{float(value):.9g}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def spark_bag(df):
    return sorted(df.columns), bag(df.columns, df.collect())


def duck_bag(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), bag(columns, cursor.fetchall())
