"""Compare a Spark result with a DuckDB result, column by column and bit by bit."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both hold the same rows, else what differs."""
    result = con.execute(sql)
    duck_columns = [c[0] for c in result.description]
    duck = _rows(duck_columns, result.fetchall())
    if sorted(duck_columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(duck_columns)}"
    ours = _rows(spark_df.columns, spark_df.collect())
    if ours == duck:
        return None
    only_ours, only_duck = ours - duck, duck - ours
    return f"{sum(ours.values())} rows, expected {sum(duck.values())}; extra {list(only_ours)[:2]}; missing {list(only_duck)[:2]}"
