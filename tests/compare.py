"""Running a query in Spark and its SQL in DuckDB, and comparing rows and types."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _sorted(rows: list[tuple]) -> list[tuple]:
    return sorted(tuple(map(_plain, row)) for row in rows) if not _has_none(rows) else sorted(
        (tuple(map(_plain, row)) for row in rows), key=repr
    )


def _has_none(rows: list[tuple]) -> bool:
    return any(value is None for row in rows for value in row)


# Spark and DuckDB names of the types that results may have.
_TYPES = {
    "smallint": "SMALLINT",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def differences(spark, query, sql: str, sf_dir: str, connection) -> list[str]:
    """What differs between the two results; empty when they agree."""
    frame = query(spark, sf_dir)
    names = sorted(frame.columns)
    relation = connection.sql(sql)
    found = []
    if sorted(relation.columns) != names:
        return [f"columns {names} against {sorted(relation.columns)}"]
    spark_types = {name: _TYPES.get(kind, kind) for name, kind in frame.dtypes}
    duck_types = dict(zip(relation.columns, map(str, relation.types)))
    for name in names:
        if spark_types[name] != duck_types[name]:
            found.append(f"type of {name}: {spark_types[name]} against {duck_types[name]}")
    ours = _sorted([tuple(row) for row in frame.select(*names).collect()])
    theirs = _sorted(relation.select(*[f'"{name}"' for name in names]).fetchall())
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} rows against {len(theirs)}")
    elif ours != theirs:
        bad = next((a, b) for a, b in zip(ours, theirs) if a != b)
        found.append(f"values: {bad}")
    return found
