"""Comparing a Spark result with SQL run by DuckDB over the same files."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _value(v: object) -> object:
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _sorted(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), _sorted(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return sorted(names), _sorted(names, result.fetchall())


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    have_names, have = spark_rows(df)
    want_names, want = sql_rows(con, sql)
    if have_names != want_names:
        return f"columns {have_names} instead of {want_names}"
    if len(have) != len(want):
        return f"{len(have)} rows instead of {len(want)}; first {have[:1]} / {want[:1]}"
    for a, b in zip(have, want, strict=True):
        if a != b:
            return f"row {a} instead of {b}"
    return None
