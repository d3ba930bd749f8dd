"""Comparison of a Spark result with the same query in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TYPE_NAMES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _plain(value):
    """A value that sorts and compares; NaN equals NaN, minus zero differs from zero."""
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "NaN") if math.isnan(value) else (2, (value, math.copysign(1, value)))
    return (3, str(value))


def compare(df: DataFrame, connection: duckdb.DuckDBPyConnection, text: str) -> list[str]:
    """What differs between the two results: columns, types, row count, rows."""
    relation = connection.sql(text)
    found = {name: TYPE_NAMES.get(kind, kind) for name, kind in df.dtypes}
    wanted = dict(zip(relation.columns, map(str, relation.types)))
    if found != wanted:
        return [f"columns {found} but {wanted}"]
    names = sorted(found)
    left = sorted(tuple(_plain(row[n]) for n in names) for row in df.collect())
    places = [relation.columns.index(n) for n in names]
    right = sorted(tuple(_plain(row[p]) for p in places) for row in relation.fetchall())
    if len(left) != len(right):
        return [f"{len(left)} rows but {len(right)}"]
    return [f"{a} but {b}" for a, b in zip(left, right) if a != b][:3]
