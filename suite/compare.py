"""Side-by-side comparison of a Spark result and its oracle, row for row."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


SAME_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs: names, types, or rows; empty if nothing does."""
    answer = connection.execute(sql)
    names = [column[0] for column in answer.description]
    types = {column[0]: str(column[1]) for column in answer.description}
    if sorted(names) != sorted(result.columns):
        return [f"columns differ: {sorted(set(names) ^ set(result.columns))}"]
    found = [
        f"{name}: {kind} against {types[name]}"
        for name, kind in result.dtypes
        if SAME_TYPES.get(kind) != types[name]
    ]
    ours = _multiset(result.columns, result.collect())
    theirs = _multiset(names, answer.fetchall())
    if ours != theirs:
        found.append(
            f"{ours.total()} rows against {theirs.total()}, "
            f"{(ours - theirs).total()} only here, such as {list((ours - theirs))[:2]}, "
            f"{(theirs - ours).total()} only there, such as {list((theirs - ours))[:2]}"
        )
    return found
