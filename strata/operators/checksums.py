"""Reconciling two tables by a tree of range checksums.

Each key range has a checksum on either side: the number of its rows, and the XOR and the sum of their hashes. Ranges that agree are
done with. Those that differ are cut into ``FANOUT`` smaller ones and summed up again, of which only their rows are read; the ranges reach the
scans as filters, so files and row groups outside them are skipped if the tables are laid out by key. When few rows are left they are
compared one by one. A level's checksums are ``FANOUT`` rows a range, whatever the tables hold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FANOUT = 64
#: Ranges of one level; neighbours are put together beyond it, so that a filter stays short.
MOST_RANGES = 256
#: A range of so many keys isn't cut any more.
LEAF_KEYS = 64


@dataclass(frozen=True)
class Range:
    """Keys from ``low`` up to and without ``high``."""

    low: int
    high: int


def _within(key: str, ranges: list[Range]) -> Column:
    found = F.lit(False)
    for r in ranges:
        found = found | ((F.col(key) >= F.lit(r.low)) & (F.col(key) < F.lit(r.high)))
    return found


def _cut(ranges: list[Range]) -> list[Range]:
    out = []
    for r in ranges:
        step = max(1, -(-(r.high - r.low) // FANOUT))
        out += [Range(low, min(r.high, low + step)) for low in range(r.low, r.high, step)]
    return out


def _joined(ranges: list[Range], most: int) -> list[Range]:
    """The same keys and more in ``most`` ranges at most: the smallest gaps go."""
    ranges = sorted(ranges, key=lambda r: r.low)
    gaps = sorted(range(1, len(ranges)), key=lambda i: ranges[i].low - ranges[i - 1].high, reverse=True)
    # ranges that touch are one in any case
    cuts = {i for i in gaps[: most - 1] if ranges[i].low > ranges[i - 1].high}
    out: list[Range] = []
    for i, r in enumerate(ranges):
        if i and i not in cuts:
            out[-1] = Range(out[-1].low, r.high)
        else:
            out.append(r)
    return out


def _row_hash(columns: list[str]) -> Column:
    return F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in columns])


def range_checksums(df: DataFrame, key: str, columns: list[str], parents: list[Range]) -> DataFrame:
    """(low, n, x, s): rows, XOR and sum of row hashes of each range that ``parents`` are cut into, without empty ones.

    ``parents`` don't overlap and all but the last are cut into equal steps.
    """
    low = F.lit(None).cast("long")
    for r in parents:
        step = max(1, -(-(r.high - r.low) // FANOUT))
        place = F.lit(r.low) + F.floor((F.col(key) - F.lit(r.low)) / F.lit(step)).cast("long") * F.lit(step)
        low = F.when((F.col(key) >= r.low) & (F.col(key) < r.high), place).otherwise(low)
    hashed = df.filter(_within(key, parents)).select(low.alias("low"), _row_hash([key, *columns]).alias("h"))
    return hashed.groupBy("low").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("x"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s")
    )


def differing_ranges(a: DataFrame, b: DataFrame, key: str, columns: list[str]) -> list[Range]:
    """The smallest ranges of an integer key whose rows differ, found from the top down."""
    bounds = [df.agg(F.min(key).cast("long"), F.max(key).cast("long")).first() for df in (a, b)]
    known = [r for r in bounds if r[0] is not None]
    if not known:
        return []
    now, done = [Range(min(r[0] for r in known), max(r[1] for r in known) + 1)], []
    while now:
        sums = [range_checksums(df, key, columns, now).select("low", *[F.col(c).alias(f"{side}{c}") for c in "nxs"]) for df, side in ((a, "a"), (b, "b"))]
        unequal = ~(F.col("an").eqNullSafe(F.col("bn")) & F.col("ax").eqNullSafe(F.col("bx")) & F.col("as").eqNullSafe(F.col("bs")))
        lows = {r[0] for r in sums[0].join(sums[1], "low", "full").filter(unequal).select("low").collect()}  # FANOUT a range
        found = [r for r in _cut(now) if r.low in lows]
        leaves = [r for r in found if r.high - r.low <= LEAF_KEYS]
        done += leaves
        before = sum(r.high - r.low for r in now)
        now = _joined([r for r in found if r.high - r.low > LEAF_KEYS], MOST_RANGES // 4)
        if 2 * sum(r.high - r.low for r in now) > before:  # where most of the keys' ranges differ, going down saves little
            done, now = done + now, []
    return _joined(done, MOST_RANGES) if done else []


def differing_rows(a: DataFrame, b: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """(key, difference): keys whose rows are ``missing`` in ``b``, ``extra`` in it, or ``changed``.

    Rows are compared by ``columns``, by default all of ``a``. Only ranges of keys whose checksums differ are read for that.
    A key that repeats is compared by the checksum of its rows. NULL keys lie in no range; they are compared apart, as one key.
    """
    columns = columns or [c for c in a.columns if c != key]
    ranges = differing_ranges(a, b, key, columns)
    wanted = F.col(key).isNull() | _within(key, ranges) if ranges else F.col(key).isNull()

    def summed(df: DataFrame, side: str) -> DataFrame:
        rows = df.filter(wanted).select(F.col(key).cast("long").alias(key), _row_hash(columns).alias("h"))
        return rows.groupBy(key).agg(
            F.count(F.lit(1)).alias(f"{side}n"), F.bit_xor("h").alias(f"{side}x"), F.sum(F.col("h").cast("decimal(38,0)")).alias(f"{side}s")
        ).withColumnRenamed(key, f"{side}k")

    both = summed(a, "a").join(summed(b, "b"), F.col("ak").eqNullSafe(F.col("bk")), "full")
    difference = (
        F.when(F.col("bn").isNull(), "missing")
        .when(F.col("an").isNull(), "extra")
        .when((F.col("an") != F.col("bn")) | (F.col("ax") != F.col("bx")) | (F.col("as") != F.col("bs")), "changed")
    )
    return both.select(F.when(F.col("an").isNull(), F.col("bk")).otherwise(F.col("ak")).alias(key), difference.alias("difference")).filter(
        "difference is not null"
    )
