"""Runs a registered query and its checking SQL over the same tables and compares them as multisets."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(folder) / name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def multiset(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(connection, spark_df, sql: str) -> tuple[int, Counter, Counter]:
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    expected = multiset(names, cursor.fetchall())
    assert sorted(names) == sorted(spark_df.columns), (sorted(names), sorted(spark_df.columns))
    found = multiset(spark_df.columns, spark_df.collect())
    return sum(found.values()), found - expected, expected - found
