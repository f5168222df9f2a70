"""Date spine and calendar dimension."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import columns as names
from strata.functions.time import calendar_parts, utc_literal


def bounds(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias("min_value"), F.max(col).alias("max_value"))


def date_spine(df: DataFrame, col: str, name: str = "date_key") -> DataFrame:
    """Every day between the column's first and last date; no rows when it has none.

    One row per calendar day, so its size is bounded by the calendar and not by the facts.
    """
    span = bounds(df.select(F.col(col).cast("date").alias(col)), col)
    return span.select(
        F.explode(F.sequence("min_value", "max_value", F.expr("INTERVAL 1 DAY"))).alias(name)
    )


def dim_date(df: DataFrame, col: str, run_ts: datetime) -> DataFrame:
    spine = date_spine(df, col)
    parts = [expr.alias(name) for name, expr in calendar_parts("date_key").items()]
    return spine.select("date_key", *parts, utc_literal(run_ts).alias(names.BUILT_AT))
