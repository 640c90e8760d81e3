"""Compare Spark rows with DuckDB rows, ignoring row order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, bool) or value is None:
        return str(value)
    return str(value)


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str, show: int = 2) -> list[str]:
    """What differs; empty if nothing does."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = _rows(names, cursor.fetchall())
    got = _rows(spark_df.columns, spark_df.collect())
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    if got == expected:
        return []
    left, right = set(got), set(expected)
    return [
        f"rows {len(got)} vs {len(expected)}",
        *[f"spark only: {str(r)[:600]}" for r in sorted(left - right)[:show]],
        *[f"sql only:   {str(r)[:600]}" for r in sorted(right - left)[:show]],
    ]
