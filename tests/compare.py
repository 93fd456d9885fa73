"""Rows of a Spark result and of a DuckDB query, in a comparable form."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(row) for row in df.select(*names).collect())


def oracle_rows(connection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    names = sorted(columns)
    places = [columns.index(name) for name in names]
    return names, Counter(tuple(row[i] for i in places) for row in result.fetchall())
