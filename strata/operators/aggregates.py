"""Aggregates with more to them than one groupBy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.conform import unused


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


#: Groups of more rows have their values counted in several tasks.
HOT_ROWS = 100_000


def sums_and_distinct(
    df: DataFrame, keys: list[str], sums: dict[str, Column], distinct: dict[str, str], stored: bool = False
) -> DataFrame:
    """Sums plus exact distinct counts of text columns per group.

    A row goes on once per distinct column (Spark's own plan for several distinct counts adds another copy for the sums, which
    ride along with the first here), without the sums but for the first. The copies are folded per group and value, before they are
    shuffled and after, and again per group: no task holds the values of a hot group. Folding per group and all values first would
    shuffle what is nearly every row once more.

    A ``stored`` frame, which is cheap to read again, is shuffled once, by group, and its copies are made and folded behind that. Only
    the groups of more than ``HOT_ROWS`` rows, found by a hash of the keys, go the other way.
    """
    values = df.select(*keys, *[c.alias(n) for n, c in sums.items()], *[F.col(c).alias(f"_value_{i}") for i, c in enumerate(distinct.values())])
    if not stored:
        return _folded(values, keys, list(sums), list(distinct))
    code = unused("_code", values)
    coded = values.withColumn(code, F.xxhash64(*keys))
    # at most one for each HOT_ROWS rows
    hot = F.broadcast(coded.groupBy(code).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT_ROWS).select(code))
    cold = coded.join(hot, code, "left_anti").drop(code).repartition(*keys)
    rest = coded.join(hot, code, "left_semi").drop(code)
    return _folded(cold, keys, list(sums), list(distinct)).unionByName(_folded(rest, keys, list(sums), list(distinct)))


def _folded(values: DataFrame, keys: list[str], sums: list[str], distinct: list[str]) -> DataFrame:
    kept = F.struct(*[F.col(n) for n in sums])
    none = F.struct(*[F.lit(None).cast(values.schema[n].dataType).alias(n) for n in sums])
    tags = [
        F.struct(F.lit(i).alias("tag"), F.col(f"_value_{i}").alias("value"), (none if i else kept).alias("sums"))
        for i in range(len(distinct))
    ]
    rows = values.select(*keys, F.inline(F.array(*tags))).select(*keys, "tag", "value", "sums.*")
    per_value = rows.groupBy(*keys, "tag", "value").agg(*[F.sum(n).alias(n) for n in sums])
    return per_value.groupBy(*keys).agg(
        *[F.sum(n).alias(n) for n in sums],
        *[F.count(F.when(F.col("tag") == i, F.col("value"))).alias(n) for i, n in enumerate(distinct)],
    )


def sync_totals(stream_stats: DataFrame, job_totals: DataFrame | None = None) -> DataFrame:
    """Records per job summed over its streams, NULL as 0; a job's own totals win where present.

    ``stream_stats``: job_id, records_emitted, records_committed per stream;
    ``job_totals``: the same columns per job. A job whose own record has either count uses that record.
    """
    counts = ["records_emitted", "records_committed"]
    summed = stream_stats.groupBy("job_id").agg(
        *[F.sum(F.coalesce(F.col(c), F.lit(0))).cast("bigint").alias(c) for c in counts]
    )
    if job_totals is None:
        return summed
    own = job_totals.select("job_id", *[F.col(c).cast("bigint").alias(f"_own_{c}") for c in counts])
    has_own = F.col("_own_records_emitted").isNotNull() | F.col("_own_records_committed").isNotNull()
    joined = summed.join(own, "job_id", "full_outer")
    return joined.select(
        "job_id", *[F.when(has_own, F.col(f"_own_{c}")).otherwise(F.col(c)).alias(c) for c in counts]
    )


def reconcile(named: dict[str, DataFrame]) -> DataFrame:
    """Row count per named table, as one frame."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in named.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def union_all(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df)
    return out


def missing(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Distinct expected rows that did not arrive."""
    return expected.distinct().join(actual.distinct(), expected.columns, "left_anti")


def ordered_arrays(df: DataFrame, keys: list[str], value: str, chunk: Column) -> DataFrame:
    """Sorted array of a group's values, cut by ``chunk``: an expression that grows with the value.

    Reading a group's arrays in ``chunk_id`` order gives ``array_agg(value order by value)`` while no
    task ever holds more than one chunk of a hot group.
    """
    return (
        df.select(*keys, chunk.alias("chunk_id"), value)
        .groupBy(*keys, "chunk_id")
        .agg(F.array_sort(F.collect_list(value)).alias("sorted_values"))
    )

