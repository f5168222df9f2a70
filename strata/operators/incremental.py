"""Incremental slices, table changes by key, and schema evolution.

One rule for every change by key: NULL is a key like any other, equal to NULL. So writing the same rows again changes
nothing, whatever their keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.conform import unused
from strata.operators.dedupe import latest_per_key
from strata.operators.joins import drop_keys, equals_null_safe, keep_keys

LOOKBACK_DAYS = 3


def high_water(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.max(col).alias("high_water"))


def read_incremental(df: DataFrame, cursor: str, last_value: object) -> DataFrame:
    """Rows from the cursor value on. The bound is a literal of the column's type, so it reaches the scan."""
    return df.filter(F.col(cursor) >= F.lit(str(last_value)).cast(df.schema[cursor].dataType))


def lookback_bound(target: DataFrame, col: str, days: int = LOOKBACK_DAYS) -> str | None:
    """High-water mark less the lookback, as text; none without a mark. One value is collected."""
    mark = F.max(col) - F.expr(f"INTERVAL {int(days)} DAYS")
    return target.agg(mark.cast("string").alias("bound")).first()["bound"]


def incremental_slice(
    src: DataFrame, target: DataFrame | None, src_col: str, tgt_col: str | None = None, days: int = LOOKBACK_DAYS
) -> DataFrame:
    """Source rows at or after the target's high-water mark less ``days``.

    Everything without a target, and as well with one that is empty or has no mark. Otherwise rows without a cursor are
    left out, and listed by :func:`late_rows`. The bound is read first and planted as a literal: it then appears in the scan's PushedFilters and
    skips row groups, which a scalar subquery would not.
    """
    if target is None:
        return src
    bound = lookback_bound(target, tgt_col or src_col, days)
    if bound is None:
        return src
    return src.filter(F.col(src_col) >= F.lit(bound).cast(src.schema[src_col].dataType))


def late_rows(
    src: DataFrame,
    target: DataFrame,
    keys: list[str],
    src_col: str,
    tgt_col: str | None = None,
    days: int = LOOKBACK_DAYS,
    compare: list[str] | None = None,
) -> DataFrame:
    """Source rows the slice leaves out although the target lacks them or holds other values."""
    text = lookback_bound(target, tgt_col or src_col, days)
    bound = F.lit(text).cast(src.schema[src_col].dataType)
    outside = src.limit(0) if text is None else src.filter(F.col(src_col).isNull() | (F.col(src_col) < bound))
    return rows_that_differ(outside, target, keys, compare)


def rows_that_differ(rows: DataFrame, stored: DataFrame, keys: list[str], compare: list[str] | None = None) -> DataFrame:
    """Rows whose key is not stored, or is with other values of ``compare`` (by default all shared columns).

    Both sides are joined by key; rows with a NULL in it, to which NULL is a value, go through a join of their own, so that
    the other one is a plain equality that Spark can turn into a filter of the stored rows.
    """
    compare = compare or [c for c in rows.columns if c not in keys and c in stored.columns]
    theirs = unused("_stored", rows)
    renamed = stored.select(*[F.col(c).alias(f"{theirs}_{c}") for c in [*keys, *compare]], F.lit(True).alias(f"{theirs}"))
    same = equals_null_safe([(F.col(c), F.col(f"{theirs}_{c}")) for c in compare])
    nullable = [k for k in keys if rows.schema[k].nullable]
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    found = []
    for some, equal in ((~no_key, lambda a, b: a == b), (no_key, lambda a, b: a.eqNullSafe(b))):
        on = F.lit(True)
        for k in keys:
            on = on & equal(F.col(k), F.col(f"{theirs}_{k}"))
        left = rows.filter(some)
        right = renamed if not found else renamed.filter(" or ".join(f"`{theirs}_{k}` is null" for k in keys))
        found.append(left.join(right, on, "left").filter(F.col(theirs).isNull() | ~same).select(*rows.columns))
        if not nullable:
            break
    return found[0] if len(found) == 1 else found[0].union(found[1])


# integers by width; each fits into those behind it
_INTEGERS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _as_decimal(kind: T.DataType) -> T.DecimalType | None:
    if isinstance(kind, T.DecimalType):
        return kind
    return T.DecimalType(_DIGITS[type(kind)], 0) if type(kind) in _DIGITS else None


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both: the wider integer, a decimal with the digits of both, a double for
    fractions, the finer of date and instant, and text for what has nothing else in common."""
    if a == b:
        return a
    if type(a) in _INTEGERS and type(b) in _INTEGERS:
        return max(a, b, key=lambda t: _INTEGERS.index(type(t)))
    floats = (T.FloatType, T.DoubleType)
    if isinstance(a, floats) or isinstance(b, floats):
        other = b if isinstance(a, floats) else a
        return T.DoubleType() if isinstance(other, floats) or _as_decimal(other) else T.StringType()
    if (x := _as_decimal(a)) and (y := _as_decimal(b)):
        scale, whole = max(x.scale, y.scale), max(x.precision - x.scale, y.precision - y.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    days = {T.DateType, T.TimestampNTZType}
    if {type(a), type(b)} == days:
        return T.TimestampNTZType()
    if {type(a), type(b)} <= {T.DateType, T.TimestampType}:
        return T.TimestampType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType) and a.fieldNames() == b.fieldNames():
        return T.StructType([T.StructField(f.name, common_type(f.dataType, g.dataType)) for f, g in zip(a, b, strict=True)])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType))
    if isinstance(a, (T.StructType, T.ArrayType, T.MapType)) or isinstance(b, (T.StructType, T.ArrayType, T.MapType)):
        raise TypeError(f"no common type of {a.simpleString()} and {b.simpleString()}")
    return T.StringType()


def not_fitting(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """Rows with a value that is lost when its column is cast to the type given for it: it can't be cast, or doesn't come back."""
    lost = F.lit(False)
    for c, kind in types.items():
        cast, own = F.col(c).try_cast(kind), df.schema[c].dataType
        lost = lost | (F.col(c).isNotNull() & (cast.isNull() | ~F.coalesce(cast.try_cast(own) == F.col(c), F.lit(False))))
    return df.filter(lost)


def evolve(
    target: DataFrame, batch: DataFrame, mode: str = "append_new", narrow: dict[str, T.DataType] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Bring both frames to one schema.

    ``append_new`` adds the batch's new columns to the target and keeps columns the batch lacks; ``sync_all`` also drops
    those. In both a column that has two types gets the least type that holds both, so nothing is lost, whichever side is
    the wider. ``narrow`` gives columns another type on request; rows that don't fit, which :func:`not_fitting` lists, get NULL there.
    ``ignore`` keeps the target's schema.
    """
    t_types = {f.name: f.dataType for f in target.schema.fields}
    b_types = {f.name: f.dataType for f in batch.schema.fields}
    if mode == "sync_all":
        wanted = {c: common_type(t_types.get(c, t), t) for c, t in b_types.items()}
    elif mode == "append_new":
        wanted = {c: common_type(t, b_types.get(c, t)) for c, t in {**b_types, **t_types}.items()}
        wanted = {c: wanted[c] for c in [*t_types, *[c for c in b_types if c not in t_types]]}
    elif mode == "ignore":
        wanted = dict(t_types)
    else:
        raise ValueError(f"unknown schema change mode {mode!r}")
    wanted |= narrow or {}

    def shaped(df: DataFrame, have: dict) -> DataFrame:
        return df.select(
            *[
                (F.col(c) if have[c] == t else F.col(c).try_cast(t) if c in (narrow or {}) else F.col(c).cast(t)).alias(c)
                if c in have
                else F.lit(None).cast(t).alias(c)
                for c, t in wanted.items()
            ]
        )

    return shaped(target, t_types), shaped(batch, b_types)


def delete_insert(
    target: DataFrame | None, batch: DataFrame, keys: list[str], on_schema_change: str = "append_new"
) -> DataFrame:
    """Target rows whose key is absent from the batch, plus the whole batch (its duplicates included)."""
    if target is None:
        return batch
    kept, fresh = evolve(target, batch, on_schema_change)
    return drop_keys(kept, batch, keys, nulls_match=True).unionByName(fresh)


def upsert(
    target: DataFrame, batch: DataFrame, keys: list[str], update_cols: list[str] | None = None
) -> DataFrame:
    """Insert new keys, update known ones; with ``update_cols`` other stored columns survive.

    Batch keys must be unique (reduce with ``latest_per_key`` first). Known and new keys go through a join each: unlike a
    full outer join, both can be split where a key is hot.
    """
    if update_cols is None:
        return delete_insert(target, batch, keys, "ignore")
    new = batch.select(*[F.col(c).alias(f"_n_{c}") for c in batch.columns], F.lit(True).alias("_new"))
    condition = equals_null_safe([(F.col(k), F.col(f"_n_{k}")) for k in keys])
    updated = target.join(new, condition, "left").select(
        *[
            F.when(F.col("_new"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in update_cols else F.col(c)
            for c in target.columns
        ]
    )
    added = drop_keys(batch, target, keys, nulls_match=True)
    missing = [F.lit(None).cast(target.schema[c].dataType).alias(c) for c in target.columns if c not in batch.columns]
    return updated.unionByName(added.select("*", *missing).select(*target.columns))


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Add only batch rows with unknown keys; one row per key, known keys stay untouched."""
    fresh = drop_keys(latest_per_key(batch, keys, []), target, keys, nulls_match=True)
    return target.unionByName(fresh, allowMissingColumns=True)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true; an unknown (NULL) condition keeps the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def append_dedup(
    target: DataFrame | None,
    batch: DataFrame,
    keys: list[str],
    cursor: list[str],
    target_is_unique: bool = False,
) -> DataFrame:
    """Append the batch, then keep the newest row per key by cursor.

    When the target already holds one row per key, only its rows that the batch touches are ranked:
    the rest passes through unsorted (and, with few batch keys, unshuffled).
    """
    if target is None:
        return latest_per_key(batch, keys, cursor)
    old, new = evolve(target, batch, "append_new")
    if not target_is_unique:
        return latest_per_key(old.unionByName(new), keys, cursor)
    untouched = drop_keys(old, batch, keys, nulls_match=True)
    contested = keep_keys(old, batch, keys, nulls_match=True).unionByName(new)
    return untouched.unionByName(latest_per_key(contested, keys, cursor))
