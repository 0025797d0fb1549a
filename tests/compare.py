"""Run a query in Spark and its statement in DuckDB and compare the rows as multisets."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb

SMALL = "/root/testdata/sf0.001"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return int(value)
    return str(value)


def multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None if both sides agree, else a short description."""
    cursor = con.execute(sql)
    duck_columns = [d[0] for d in cursor.description]
    duck = multiset(duck_columns, cursor.fetchall())
    ours = multiset(spark_df.columns, spark_df.collect())
    if sorted(duck_columns) != sorted(spark_df.columns):
        return f"columns differ: {sorted(spark_df.columns)} and {sorted(duck_columns)}"
    if ours != duck:
        extra, lacking = ours - duck, duck - ours
        return (
            f"{sum(ours.values())} rows and {sum(duck.values())} rows; "
            f"{sum(extra.values())} only in Spark {list(extra)[:2]}, {sum(lacking.values())} only in DuckDB {list(lacking)[:2]}"
        )
    return None
