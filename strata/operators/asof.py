"""Looking facts up in a history: the version of a key that was valid at the fact's time.

An interval condition alone would be a nested loop, and a sort of each key's events would put a hot key into one task. So
time is cut into bins. A version is put into bins of the finest level at which it touches two of them at most; long versions
into coarse bins, short ones into fine ones. A fact looks into its one bin of each level that the history uses. Fact and version meet by
equality on key, level and bin, and the interval is compared within. A hot key is spread over its bins, and beyond that its
facts over the splits of a skewed join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.conform import unused

#: Seconds of the finest bin, and by how much each level is coarser. The last one holds any span of years.
BIN_SECONDS, STEP, LEVELS = 3600, 16, 9


def _seconds(instant: Column) -> Column:
    return F.unix_micros(instant.cast("timestamp")) / F.lit(1_000_000)


def _bin(seconds: Column, level: int) -> Column:
    return F.floor(seconds / F.lit(BIN_SECONDS * STEP**level)).cast("long")


def as_of(
    facts: DataFrame, history: DataFrame, key: str, at: str, valid_from: str, valid_to: str, take: list[str] | None = None
) -> DataFrame:
    """Facts with the columns ``take`` (by default all others) of their key's version with ``valid_from <= at < valid_to``.

    A NULL ``valid_to`` is open. Facts without such a version, without a key or a time, are left out. Versions that overlap
    give a row each. ``at`` and both bounds are instants.
    """
    take = take or [c for c in history.columns if c not in (key, valid_from, valid_to)]
    mine, theirs = unused("_bin", facts), unused("_version", facts, history)
    start = _seconds(F.col(valid_from))
    end = F.coalesce(_seconds(F.col(valid_to)), start + F.lit(BIN_SECONDS * STEP ** (LEVELS - 1)))
    level = F.lit(LEVELS - 1)
    for i in reversed(range(LEVELS - 1)):
        level = F.when(F.col(valid_to).isNotNull() & (end - start <= BIN_SECONDS * STEP**i), i).otherwise(level)
    versions = history.filter(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(key).alias(f"{theirs}_key"),
        F.col(valid_from).alias(f"{theirs}_from"),
        F.col(valid_to).alias(f"{theirs}_to"),
        *take,
        level.alias(f"{theirs}_level"),
        start.alias(f"{theirs}_start"),
        end.alias(f"{theirs}_end"),
    )
    # open versions lie in the coarsest bin of their start and of all times after it that a calendar knows: two at most
    spots = F.lit(None).cast("array<bigint>")
    for i in range(LEVELS):
        first, last = _bin(F.col(f"{theirs}_start"), i), _bin(F.col(f"{theirs}_end"), i)
        spots = F.when(F.col(f"{theirs}_level") == i, F.array_distinct(F.array(first, last))).otherwise(spots)
    versions = versions.withColumn(f"{theirs}_bin", F.explode(spots)).drop(f"{theirs}_start", f"{theirs}_end")
    used = [r[0] for r in versions.select(f"{theirs}_level").distinct().collect()]  # LEVELS at most
    if not used:
        return facts.join(versions, F.lit(False)).select(*facts.columns, *take)
    looks = F.array(*[F.struct(F.lit(i).alias("level"), _bin(_seconds(F.col(at)), i).alias("bin")) for i in sorted(used)])
    looking = facts.filter(F.col(key).isNotNull() & F.col(at).isNotNull()).withColumn(mine, F.explode(looks))
    met = looking.join(
        versions,
        (F.col(key) == F.col(f"{theirs}_key"))
        & (F.col(f"{mine}.level") == F.col(f"{theirs}_level"))
        & (F.col(f"{mine}.bin") == F.col(f"{theirs}_bin")),
    )
    valid = (F.col(at) >= F.col(f"{theirs}_from")) & (F.col(f"{theirs}_to").isNull() | (F.col(at) < F.col(f"{theirs}_to")))
    return met.filter(valid).select(*facts.columns, *take)
