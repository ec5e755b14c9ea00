"""Comparing a Spark result with a DuckDB result: names, types and values."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb

# DuckDB's name for each Spark type in use.
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(folder: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        connection.execute(f"create view {name} as select * from '{files}'")
    return connection


def mismatch(df, connection, sql: str, limit: int = 5) -> str | None:
    """None when both agree as multisets of rows, else what differs."""
    expected = connection.sql(sql)
    want_types = dict(zip(expected.columns, map(str, expected.types)))
    have_types = {}
    for name, dtype in df.dtypes:
        have_types[name] = TYPES.get(dtype, dtype.upper())
    want_types = {name: dtype.replace(" ", "") for name, dtype in want_types.items()}
    if have_types != want_types:
        return f"columns: spark {have_types}, duckdb {want_types}"
    names = sorted(have_types)
    order = [expected.columns.index(name) for name in names]
    want = Counter(tuple(row[i] for i in order) for row in expected.fetchall())
    have = Counter(tuple(row) for row in df.select(names).collect())
    if want == have:
        return None
    only_spark = list((have - want).items())
    only_duck = list((want - have).items())
    return (
        f"{names}: {sum(have.values())} rows against {sum(want.values())}; "
        f"{len(only_spark)} only in spark, e.g. {only_spark[:limit]}; "
        f"{len(only_duck)} only in duckdb, e.g. {only_duck[:limit]}"
    )
