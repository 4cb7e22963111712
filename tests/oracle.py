"""Compare a Spark result with its SQL check run by DuckDB on the same parquet tables."""

from __future__ import annotations

import glob
import os

import duckdb

COUNT_LIKE = {"TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double",
              "VARCHAR": "string", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def rows_of(frame) -> tuple[list[str], list[tuple]]:
    """Columns by name, and the rows as sorted comparable tuples."""
    columns = sorted(frame.columns)
    picked = [tuple(row[c] for c in columns) for row in frame.collect()]
    return columns, sorted(picked, key=repr)


def check_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple], dict[str, str]]:
    found = con.sql(sql)
    types = dict(zip(found.columns, [str(t) for t in found.types]))
    columns = sorted(found.columns)
    place = [found.columns.index(c) for c in columns]
    return columns, sorted((tuple(row[i] for i in place) for row in found.fetchall()), key=repr), types


def differences(frame, con, sql: str) -> list[str]:
    """What differs, in words; empty when the results agree exactly."""
    columns, rows = rows_of(frame)
    expected_columns, expected, types = check_rows(con, sql)
    problems = []
    if columns != expected_columns:
        return [f"columns {columns} != {expected_columns}"]
    for name, kind in types.items():
        mine = frame.schema[name].dataType.simpleString()
        if COUNT_LIKE.get(kind, kind) != mine:
            problems.append(f"type of {name}: {mine} != {kind}")
    if len(rows) != len(expected):
        problems.append(f"{len(rows)} rows != {len(expected)}")
    if rows != expected:
        pairs = [(a, b) for a, b in zip(rows, expected) if a != b][:3]
        problems.append(f"values, columns {columns}: {pairs}")
    return problems
