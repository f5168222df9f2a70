"""Key-membership joins that stay balanced, and the star joins of the warehouse.

Nothing here forces a broadcast: Spark broadcasts a side by itself once its estimated or measured
size is under ``spark.sql.autoBroadcastJoinThreshold``, and sort-merges otherwise.

Membership joins guard against skew on either side:

* the key side is reduced to distinct keys first (map-side combine folds a hot key away);
* rows with a NULL key, which match nothing, are spread by a hash of the row instead of meeting in
  one task;
* the spread column also makes both sides exchange right below the sort-merge join, the shape AQE
  needs to split a partition that one hot non-NULL key fills.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.conform import require_not_null, unused

SPREAD = 1024
_UNHASHABLE = (T.MapType, T.VariantType)


def _pairs(on: str | list[str] | dict[str, str]) -> dict[str, str]:
    if isinstance(on, str):
        return {on: on}
    return dict(on) if isinstance(on, dict) else {k: k for k in on}


def _member_join(
    df: DataFrame, keys: DataFrame, on: str | list[str] | dict[str, str], how: str, nulls_match: bool
) -> DataFrame:
    pairs = _pairs(on)
    left_null = F.lit(False)
    if not nulls_match:
        for c in pairs:
            left_null = left_null | F.col(c).isNull()
    # pmod(x, 1) is always 0, written so that the optimizer keeps it as a join key
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, _UNHASHABLE)]
    spread = F.when(left_null, F.pmod(F.xxhash64(*hashed), F.lit(SPREAD)) + 1).otherwise(
        F.pmod(F.xxhash64(*pairs), F.lit(1))
    )
    ours, theirs = unused("_spread", df), unused("_key", df)
    left = df.withColumn(ours, spread)
    right = (
        keys.select(*[F.col(r).alias(f"{theirs}_{i}") for i, r in enumerate(pairs.values())])
        .distinct()
        .withColumn(f"{theirs}_spread", F.pmod(F.xxhash64(*[f"{theirs}_{i}" for i in range(len(pairs))]), F.lit(1)))
    )
    condition = F.col(ours) == F.col(f"{theirs}_spread")
    for i, c in enumerate(pairs):
        key = F.col(f"{theirs}_{i}")
        condition = condition & (F.col(c).eqNullSafe(key) if nulls_match else F.col(c) == key)
    return left.join(right, condition, how).drop(ours)


def keep_keys(
    df: DataFrame, keys: DataFrame, on: str | list[str] | dict[str, str], nulls_match: bool = False
) -> DataFrame:
    """Rows whose key occurs in ``keys`` (EXISTS). ``on`` maps df columns to key columns.

    NULL equals nothing unless ``nulls_match`` makes it a key like any other.
    """
    known = df if nulls_match else require_not_null(df, list(_pairs(on)))
    return _member_join(known, keys, on, "left_semi", nulls_match)


def drop_keys(
    df: DataFrame, keys: DataFrame, on: str | list[str] | dict[str, str], nulls_match: bool = False
) -> DataFrame:
    """Rows whose key does not occur in ``keys`` (NOT EXISTS); a NULL key stays unless ``nulls_match``."""
    return _member_join(df, keys, on, "left_anti", nulls_match)


def orphans(child: DataFrame, parent: DataFrame, on: str | dict[str, str]) -> DataFrame:
    """Child rows without a parent (LEFT JOIN ... IS NULL); a NULL child key counts as an orphan."""
    return drop_keys(child, parent, on)


def enrich_lines(items: DataFrame, orders: DataFrame, materials: DataFrame, partners: DataFrame) -> DataFrame:
    """Order lines with header, material and partner columns; lines lacking any of them vanish.

    Inputs must not share column names beyond the join keys. The partner's columns join the headers, of which there are fewer
    than lines: the lines are shuffled for their materials and headers only, and without the headers' columns.
    """
    return items.join(materials, "material_number").join(orders.join(partners, "partner_number"), "sales_order_number")


def series_join(df: DataFrame, start: int, stop: int, name: str = "n") -> DataFrame:
    """Each row once per integer in start..stop, by exploding a sequence (no cross join, no shuffle)."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(start), F.lit(stop))))


def star_query(fct: DataFrame, dim_customer: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Facts with customer and calendar attributes."""
    return fct.join(dim_customer, "customer_id").join(
        dim_date, fct["order_date_key"] == dim_date["date_key"]
    )


def equals_null_safe(pairs: list[tuple[Column, Column]]) -> Column:
    """True when every pair is equal, NULL equal to NULL."""
    same = F.lit(True)
    for a, b in pairs:
        same = same & a.eqNullSafe(b)
    return same
