"""Compare a query with its SQL statement, column by column."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def sql_engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def _multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when columns, types of values and rows are the same."""
    found = con.sql(sql)
    mine, theirs = list(spark_df.columns), list(found.columns)
    if sorted(mine) != sorted(theirs):
        return [f"columns {sorted(mine)} != {sorted(theirs)}"]
    a, b = _multiset(mine, spark_df.collect()), _multiset(theirs, found.fetchall())
    if a == b:
        return []
    return [
        f"{sum(a.values())} rows != {sum(b.values())} rows" if sum(a.values()) != sum(b.values()) else "values differ",
        str(sorted(mine)),
        f"spark only: {list((a - b).items())[:3]}",
        f"sql only:   {list((b - a).items())[:3]}",
    ]
