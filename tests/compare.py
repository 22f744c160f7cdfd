"""Run catalog queries and their SQL side by side."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return float(f"{value:.9g}") if math.isfinite(value) else str(value)
    return value


def bag(columns, data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(row[i]) for i in order) for row in data)


def difference(spark_df, con, sql: str) -> str:
    """Empty if both give the same columns and rows, else a description."""
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    expected = bag(columns, result.fetchall())
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(columns)}"
    got = bag(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got == expected:
        return ""
    more, less = list((got - expected).items())[:2], list((expected - got).items())[:2]
    return (f"{sum(got.values())} rows, expected {sum(expected.values())}; "
            f"{sum((got - expected).values())} differ: got {str(more)[:700]} expected {str(less)[:700]}")
