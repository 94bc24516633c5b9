"""Order-insensitive comparison of a Spark result with a SQL result over the same tables."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

SCALES = "/root/testdata"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def cell(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, list):
        return tuple(cell(v) for v in value)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(cell(row[i]) for i in order) for row in rows)


def of_spark(df):
    return table(df.columns, [tuple(row) for row in df.collect()])


def of_sql(con, sql):
    result = con.execute(sql)
    return table([d[0] for d in result.description], result.fetchall())
