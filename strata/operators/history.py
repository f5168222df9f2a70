"""Type-2 history: one row per key and version, an open version has no ``valid_to``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata import columns as names
from strata.functions.time import INSTANT, utc_literal
from strata.operators.dedupe import latest_per_key
from strata.operators.joins import drop_keys, keep_keys

#: A key's versions are cut at up to so many quantiles.
CHUNKS = 1000
SCD_COLUMNS = [names.SCD_ID, names.SCD_UPDATED_AT, names.SCD_VALID_FROM, names.SCD_VALID_TO]


def scd_id(key: Column, updated_at: Column) -> Column:
    text = [F.coalesce(c.cast("string"), F.lit("")) for c in (key, updated_at)]
    return F.md5(F.concat(text[0], F.lit("|"), text[1]))


def _opened(key: str, updated_at: str) -> list[Column]:
    stamp = F.col(updated_at).cast(INSTANT)
    return [
        scd_id(F.col(key), stamp).alias(names.SCD_ID),
        stamp.alias(names.SCD_UPDATED_AT),
        stamp.alias(names.SCD_VALID_FROM),
        F.lit(None).cast(INSTANT).alias(names.SCD_VALID_TO),
    ]


def scd2_start(current: DataFrame, key: str, updated_at: str) -> DataFrame:
    """The first snapshot: every row is an open version."""
    return current.select(*current.columns, *_opened(key, updated_at))


def scd2_apply(
    history: DataFrame | None,
    current: DataFrame,
    key: str,
    updated_at: str,
    run_ts: datetime,
    hard_deletes: bool = True,
) -> DataFrame:
    """History after comparing its open versions with the current rows (one row per key).

    A newer ``updated_at`` closes the open version at that time and opens the next; equal or older
    changes nothing. With ``hard_deletes`` a key that left the source is closed at ``run_ts``; if it
    comes back it opens anew. NULL is a key like any other. Closed versions pass through untouched and
    unshuffled; open versions meet the current rows in a left join whose matched pairs fan out into the
    closed and the new row, and current rows without an open version are added.
    """
    if history is None:
        return scd2_start(current, key, updated_at)
    business = current.columns
    closed = history.filter(F.col(names.SCD_VALID_TO).isNotNull())
    opened = history.filter(F.col(names.SCD_VALID_TO).isNull())
    fresh = scd2_start(current, key, updated_at)

    out = [*business, *SCD_COLUMNS]
    old = opened.select(F.struct(*out).alias("old"), F.col(key).alias("_old_key"))
    new = fresh.select(F.struct(*out).alias("new"), F.col(key).alias("_new_key"))
    both = old.join(new, F.col("_old_key").eqNullSafe(F.col("_new_key")), "left")

    in_new = F.col("new").isNotNull()
    newer = F.col(f"new.{names.SCD_UPDATED_AT}") > F.col(f"old.{names.SCD_VALID_FROM}")
    valid_to = F.when(newer, F.col(f"new.{names.SCD_VALID_FROM}"))
    if hard_deletes:
        valid_to = valid_to.when(~in_new, utc_literal(run_ts))
    kept = F.col("old").withField(names.SCD_VALID_TO, valid_to)
    replacing = F.when(in_new & newer, F.col("new"))
    changed = both.select(F.explode(F.array_compact(F.array(kept, replacing))).alias("row")).select("row.*")
    added = drop_keys(fresh, opened, key, nulls_match=True).select(*out)
    return closed.select(*out).unionByName(changed).unionByName(added)


def scd2_build(changes: DataFrame, key: str, updated_at: str, chunk_rows: int = 1_000_000) -> DataFrame:
    """Whole history from a change feed: each version ends where the key's next one begins.

    The successor is looked up inside a chunk of a key's time and, for the last row of a chunk, taken from
    the first row of the key's next chunk. A key with more than ``chunk_rows`` versions is cut into chunks of about that many at
    quantiles of its own instants, so it is sorted in as many tasks, however close together its versions are.
    """
    versions = latest_per_key(changes, [key, updated_at], [])
    instant = F.unix_micros(F.col(updated_at).cast("timestamp"))
    sizes = changes.groupBy(F.col(key).alias("_k_key")).agg(F.count(F.lit(1)).alias("_n"))
    hot = sizes.filter(F.col("_n") > chunk_rows)
    # quantiles of the hot keys only; each takes part with partial sketches of fixed size
    shares = [i / CHUNKS for i in range(1, CHUNKS)]
    cuts = (
        keep_keys(changes, hot, {key: "_k_key"}, nulls_match=True)
        .groupBy(F.col(key).alias("_k_key"))
        .agg(F.percentile_approx(instant, shares, 10 * CHUNKS).alias("_quantiles"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_step", F.greatest(F.floor(F.lit(CHUNKS) * chunk_rows / F.col("_n")), F.lit(1)).cast("int"))
        .select("_k_key", F.array_distinct(F.filter("_quantiles", lambda _, i: (i + 1) % F.col("_step") == 0)).alias("_cuts"))
    )
    # NULL instants come first
    place = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= instant)), F.lit(0))
    chunked = versions.join(cuts, F.col(key).eqNullSafe(F.col("_k_key")), "left").select(*versions.columns, place.alias("_chunk"))
    per_chunk = chunked.groupBy(F.col(key).alias("_c_key"), F.col("_chunk").alias("_c_chunk")).agg(
        F.min(updated_at).alias("_first")
    )
    next_chunk = per_chunk.withColumn(
        "_next_first", F.lead("_first").over(Window.partitionBy("_c_key").orderBy("_c_chunk"))
    ).drop("_first")
    inside = F.lead(updated_at).over(Window.partitionBy(key, "_chunk").orderBy(updated_at))
    ranked = chunked.withColumn("_next", inside)
    joined = ranked.join(
        next_chunk, F.col(key).eqNullSafe(F.col("_c_key")) & (F.col("_chunk") == F.col("_c_chunk")), "left"
    )
    stamp = F.col(updated_at).cast(INSTANT)
    return joined.select(
        *changes.columns,
        scd_id(F.col(key), stamp).alias(names.SCD_ID),
        stamp.alias(names.SCD_UPDATED_AT),
        stamp.alias(names.SCD_VALID_FROM),
        F.coalesce("_next", "_next_first").cast(INSTANT).alias(names.SCD_VALID_TO),
    )
