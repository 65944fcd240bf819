"""Run registered queries on Spark and their SQL on DuckDB and compare rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    return repr(list(value)) if isinstance(value, (list, tuple)) else repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None where both agree, else what differs."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    got = [tuple(r) for r in spark_df.collect()]
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(columns)}"
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}"
    a, b = _rows(spark_df.columns, got), _rows(columns, expected)
    for x, y in zip(a, b):
        if x != y:
            return f"{str(x)[:400]} != {str(y)[:400]}"
    return None
