"""Runs a query on Spark and its SQL in DuckDB, and compares the rows."""

from __future__ import annotations

import glob
import os

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _family(kind: str) -> str:
    kind = kind.lower()
    if kind in ("bigint", "hugeint", "int", "integer", "smallint", "tinyint", "uinteger"):
        return "whole"
    return {"varchar": "string", "timestamp_ntz": "timestamp"}.get(kind, kind)


def _rows(columns: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def differences(actual: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns, kinds and rows agree."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    kinds = {d[0]: _family(str(d[1])) for d in expected.description}
    ours = {name: _family(kind) for name, kind in actual.dtypes}
    if sorted(ours) != sorted(kinds):
        return [f"columns {sorted(ours)} != {sorted(kinds)}"]
    found = [f"kind of {n}: {ours[n]} != {kinds[n]}" for n in names if ours[n] != kinds[n]]
    left = _rows(actual.columns, [tuple(row) for row in actual.collect()])
    right = _rows(names, expected.fetchall())
    if len(left) != len(right):
        found.append(f"{len(left)} rows != {len(right)}")
    if left != right:
        extra = sorted(set(left) - set(right))[:3]
        lost = sorted(set(right) - set(left))[:3]
        found.append(f"only here: {extra}; only there: {lost}")
    return found
