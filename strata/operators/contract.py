"""Schema contracts and load-mode contracts."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.aggregates import duplicate_keys
from strata.operators.conform import require_not_null


class ContractError(ValueError):
    """The frame does not have the promised names and types."""


def enforce_contract(df: DataFrame, contract: T.StructType, allow_extra: bool = False) -> DataFrame:
    """The frame in contract column order, or an error naming every mismatch. Runs no job."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in contract.fields:
        if f.name not in have:
            problems.append(f"missing column {f.name}")
        elif have[f.name] != f.dataType:
            problems.append(f"{f.name} is {have[f.name].simpleString()}, contract says {f.dataType.simpleString()}")
    extra = [c for c in df.columns if c not in contract.fieldNames()]
    if extra and not allow_extra:
        problems.append(f"columns outside the contract: {', '.join(extra)}")
    if problems:
        raise ContractError("; ".join(problems))
    return df.select(*contract.fieldNames(), *(extra if allow_extra else []))


@dataclass(frozen=True)
class LoadSpec:
    """How a stream is meant to be loaded."""

    stream: str
    primary_key: list[str]
    cursor: str | None = None
    sync_mode: str = "incremental"
    destination_mode: str = "append_dedup"
    columns: list[str] = field(default_factory=list)


def load_modes(spark: SparkSession, specs: Iterable[LoadSpec]) -> DataFrame:
    """Specs as rows, for :func:`load_mode_violations`."""
    rows = [(s.stream, s.sync_mode, s.destination_mode, s.cursor, s.primary_key) for s in specs]
    schema = "stream string, sync_mode string, destination_mode string, cursor string, primary_key array<string>"
    return spark.createDataFrame(rows, schema)


def check_load_contract(df: DataFrame, spec: LoadSpec, last_high_water: object = None) -> DataFrame:
    """Violations of the load contract in the landed stream: (stream, rule, failing_rows), empty if none.

    Rules: declared columns present, key and cursor non-NULL, key unique under append_dedup, and the
    cursor's high-water mark not behind the last recorded one.
    """
    declared = list(dict.fromkeys([*spec.columns, *spec.primary_key, *([spec.cursor] if spec.cursor else [])]))
    absent = [c for c in declared if c not in df.columns]
    aggs = [F.lit(1 if c in absent else 0).cast("bigint").alias(f"column {c} present") for c in declared]
    keys = [c for c in spec.primary_key if c not in absent]
    for c in keys:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"key {c} not null"))
    if spec.cursor and spec.cursor not in absent:
        cursor = F.col(spec.cursor)
        aggs.append(F.count_if(cursor.isNull()).alias("cursor not null"))
        if last_high_water is not None:
            mark = F.lit(str(last_high_water)).cast(df.schema[spec.cursor].dataType)
            behind = F.coalesce(F.max(cursor) < mark, F.lit(True))
            aggs.append(behind.cast("bigint").alias("high water not going back"))
    checks = _unpivot(df.agg(*aggs), spec.stream)
    if spec.destination_mode == "append_dedup" and len(keys) == len(spec.primary_key):
        dup = duplicate_keys(require_not_null(df, keys), keys).agg(F.count(F.lit(1)).alias("failing_rows"))
        checks = checks.unionByName(
            dup.select(F.lit(spec.stream).alias("stream"), F.lit("key unique").alias("rule"), "failing_rows")
        )
    return checks.filter("failing_rows > 0")


def load_mode_violations(declared: DataFrame, configured: DataFrame) -> DataFrame:
    """Where streams are configured otherwise than declared: (stream, rule, declared, configured).

    Both frames have stream, sync_mode, destination_mode, cursor and primary_key (an array; its order does not count).
    A stream that one side lacks is a violation of the rule "stream".
    """
    shape = ["sync_mode", "destination_mode", "cursor", "primary_key"]

    def sides(df: DataFrame, name: str) -> DataFrame:
        keys = F.array_join(F.array_sort("primary_key"), ",")
        return df.select("stream", F.struct(*shape[:3], keys.alias("primary_key")).alias(name))

    both = sides(declared, "d").join(sides(configured, "c"), "stream", "full")
    rules = [
        F.when(
            F.col("d").isNotNull() & F.col("c").isNotNull() & ~F.col(f"d.{c}").eqNullSafe(F.col(f"c.{c}")),
            F.struct(F.lit(c).alias("rule"), F.col(f"d.{c}").alias("declared"), F.col(f"c.{c}").alias("configured")),
        )
        for c in shape
    ]

    def present(side: str):
        return F.when(F.col(side).isNotNull(), F.col("stream"))

    lone = F.when(
        F.col("d").isNull() | F.col("c").isNull(),
        F.struct(F.lit("stream").alias("rule"), present("d").alias("declared"), present("c").alias("configured")),
    )
    found = F.array_compact(F.array(*rules, lone))
    return both.select("stream", F.explode(found).alias("v")).select("stream", "v.*")


def check_streams(expected: Iterable[LoadSpec], landed: dict[str, DataFrame]) -> list[str]:
    """Names of expected streams that did not land."""
    return sorted({s.stream for s in expected} - set(landed))


def _unpivot(row: DataFrame, stream: str) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("rule"), F.col(f"`{c}`").cast("bigint").alias("failing_rows")) for c in row.columns]
    return row.select(F.explode(F.array(*pairs)).alias("c")).select(
        F.lit(stream).alias("stream"), "c.rule", "c.failing_rows"
    )
