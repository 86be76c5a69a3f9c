"""Runs a query in Spark and its SQL in DuckDB and compares the rows as multisets."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def sql_rows(connection, sql: str) -> tuple[list[str], Counter]:
    relation = connection.sql(sql)
    names = sorted(relation.columns)
    order = [relation.columns.index(name) for name in names]
    return names, Counter(tuple(row[i] for i in order) for row in relation.fetchall())


def spark_rows(frame) -> tuple[list[str], Counter]:
    names = sorted(frame.columns)
    order = [frame.columns.index(name) for name in names]
    return names, Counter(tuple(row[i] for i in order) for row in frame.collect())
