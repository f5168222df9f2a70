"""One row per key.

The rank = 1 filter directly over the window lets Spark plan a WindowGroupLimit on both sides of the
shuffle: every map task sends at most one row per key, so a key holding a third of the table costs
one row per task on the wire instead of a third of the table in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.conform import unused

UNORDERABLE = (T.MapType, T.VariantType)


def tie_breakers(df: DataFrame, used: set[str]) -> list[Column]:
    """All remaining comparable columns, so that equal ranks still resolve the same way every run."""
    return [
        F.col(f"`{f.name}`").desc_nulls_last()
        for f in df.schema.fields
        if f.name not in used and not isinstance(f.dataType, UNORDERABLE)
    ]


def latest_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """The row with the greatest ``order_cols`` per key, NULLs losing. A NULL key is a key of its own."""
    orders = [F.col(c).desc_nulls_last() for c in order_cols]
    return _first(df, keys, orders, {*keys, *order_cols})


def first_per_key(df: DataFrame, keys: list[str], orders: list[Column]) -> DataFrame:
    """The first row per key under explicit orderings (say ``desc_nulls_first`` to let NULLs win)."""
    return _first(df, keys, orders, set(keys))


def _first(df: DataFrame, keys: list[str], orders: list[Column], used: set[str]) -> DataFrame:
    ordering = [*orders, *tie_breakers(df, used)]
    if not ordering:
        return df.distinct()
    window = Window.partitionBy(*keys).orderBy(*ordering)
    rank = unused("_rank", df)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)
