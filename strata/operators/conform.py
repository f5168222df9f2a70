"""Projection and row-filter operators."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import columns as names
from strata.functions.time import utc_literal


def conform(df: DataFrame, mapping: Mapping[str, Column | tuple[str, str]]) -> DataFrame:
    """Rename and cast: ``{new_name: (old_name, type)}`` or ``{new_name: expression}``.

    Under ANSI a value that does not fit the type fails the job instead of turning NULL.
    """
    out = []
    for new, spec in mapping.items():
        expr = F.col(spec[0]).cast(spec[1]) if isinstance(spec, tuple) else spec
        out.append(expr.alias(new))
    return df.select(*out)


def unused(name: str, *frames: DataFrame) -> str:
    """The name, with underscores behind it until no frame has a column that begins with it."""
    taken = [c.lower() for df in frames for c in df.columns]
    while any(c.startswith(name.lower()) for c in taken):
        name += "_"
    return name


def require_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows with a value in every listed column; plain IS NOT NULL filters, which reach the scan."""
    for c in cols:
        df = df.filter(F.col(c).isNotNull())
    return df


def exclude_value(df: DataFrame, col: str, value: object) -> DataFrame:
    """Rows whose column differs from the value; rows with NULL there are dropped too."""
    return df.filter(F.col(col) != F.lit(value))


def with_run_ts(df: DataFrame, run_ts: datetime, name: str = names.BUILT_AT) -> DataFrame:
    return df.withColumn(name, utc_literal(run_ts))


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()
