"""Mirror deletes: keep only rows whose key still exists upstream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.joins import drop_keys, keep_keys


def _key_text(df: DataFrame, col: str, raw_compare: bool) -> Column:
    # integer keys compare alike as numbers and as text, so they skip the conversion
    kind = df.schema[col].dataType
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType)):
        return F.col(col).cast("bigint")
    text = F.col(col).cast("string")
    return text if raw_compare else F.trim(text)


def _comparable(target: DataFrame, tkey: str, source: DataFrame, skey: str, raw_compare: bool):
    t, s = _key_text(target, tkey, raw_compare), _key_text(source, skey, raw_compare)
    whole = (T.LongType, T.IntegerType, T.ShortType)
    if isinstance(target.schema[tkey].dataType, whole) != isinstance(source.schema[skey].dataType, whole):
        t, s = t.cast("string"), s.cast("string")
    return target.withColumn("_prune_key", t), source.select(s.alias("_prune_key"))


def prune(
    target: DataFrame, source: DataFrame, tkey: str, skey: str | None = None, raw_compare: bool = False
) -> DataFrame:
    """Target rows whose key, compared as text, occurs in the source; NULL keys go.

    Keys are trimmed on both sides; ``raw_compare=True`` compares them as stored, which deletes rows
    whose source key carries padding.
    """
    marked, keys = _comparable(target, tkey, source, skey or tkey, raw_compare)
    return keep_keys(marked, keys, "_prune_key").drop("_prune_key")


def absent_rows(
    target: DataFrame, source: DataFrame, tkey: str, skey: str | None = None, raw_compare: bool = False
) -> DataFrame:
    """The complement of :func:`prune`: target rows that a prune would delete."""
    marked, keys = _comparable(target, tkey, source, skey or tkey, raw_compare)
    return drop_keys(marked, keys, "_prune_key").drop("_prune_key")
