"""Data-quality checks. A check yields its violations; none means it passes."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.time import utc_literal
from strata.operators.aggregates import duplicate_keys
from strata.operators.conform import require_not_null
from strata.operators.dedupe import tie_breakers
from strata.operators.joins import drop_keys, keep_keys

WARN_HOURS = 36
ERROR_HOURS = 48
PREVIEW_ROWS = 5


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, col: str | list[str]) -> DataFrame:
    """Values that occur more than once (NULLs ignored), with their count."""
    cols = [col] if isinstance(col, str) else col
    return duplicate_keys(require_not_null(df, cols), cols)


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child values without a parent and how many child rows carry each; a NULL child passes.

    Both sides are reduced to one row per value before they meet, so a hot value travels as one row per
    task, and the join reuses the partitioning of the two aggregates.
    """
    counted = require_not_null(child, [col]).groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))
    parents = parent.select(F.col(parent_col).alias("_parent")).distinct()
    return counted.join(parents, F.col(col) == F.col("_parent"), "left_anti")


def _range_broken(value: Column, low: object, high: object, inclusive: bool) -> Column:
    ok = F.lit(True)
    if low is not None:
        ok = ok & (value >= F.lit(low) if inclusive else value > F.lit(low))
    if high is not None:
        ok = ok & (value <= F.lit(high) if inclusive else value < F.lit(high))
    return ~ok


def accepted_range(
    df: DataFrame, col: str, low: object = None, high: object = None, inclusive: bool = True
) -> DataFrame:
    """Rows outside the range; NULL passes."""
    return df.filter(_range_broken(F.col(col), low, high, inclusive))


def rule(violations: DataFrame) -> DataFrame:
    """A hand-written check: every row it returns is a failure."""
    return violations


@dataclass(frozen=True)
class Check:
    """One check of a table. ``kind``: not_null, accepted_range, unique, relationships or rule."""

    name: str
    kind: str
    df: DataFrame
    col: str | list[str] | None = None
    parent: DataFrame | None = None
    parent_col: str | None = None
    low: object = None
    high: object = None
    inclusive: bool = True

    def violations(self) -> DataFrame:
        if self.kind == "not_null":
            return not_null(self.df, self.col)
        if self.kind == "unique":
            return unique(self.df, self.col)
        if self.kind == "relationships":
            return relationships(self.df, self.col, self.parent, self.parent_col)
        if self.kind == "accepted_range":
            return accepted_range(self.df, self.col, self.low, self.high, self.inclusive)
        return rule(self.df)

    @property
    def row_condition(self) -> Column | None:
        """The failing condition, where one row decides for itself."""
        if self.kind == "not_null":
            return F.col(self.col).isNull()
        if self.kind == "accepted_range":
            return _range_broken(F.col(self.col), self.low, self.high, self.inclusive)
        return None


def checks_for(
    table: str,
    df: DataFrame,
    not_null: Iterable[str] = (),
    unique: Iterable[str] = (),
    relationships: dict[str, tuple[DataFrame, str]] | None = None,
    ranges: dict[str, tuple[object, object]] | None = None,
) -> list[Check]:
    """The declared column checks of one table."""
    out = [Check(f"not_null_{table}_{c}", "not_null", df, c) for c in not_null]
    out += [Check(f"unique_{table}_{c}", "unique", df, c) for c in unique]
    for c, (parent, parent_col) in (relationships or {}).items():
        out.append(Check(f"relationships_{table}_{c}", "relationships", df, c, parent, parent_col))
    for c, (low, high) in (ranges or {}).items():
        out.append(Check(f"accepted_range_{table}_{c}", "accepted_range", df, c, low=low, high=high))
    return out


def run_checks(checks: list[Check]) -> DataFrame:
    """(check_name, failing_rows) for all checks, as one query.

    Checks that a row decides alone are counted together in a single pass over their table; only
    uniqueness, relationships and rules get a branch of their own. Failing rows of a relationship
    check are child rows, of a uniqueness check duplicated values.
    """
    by_table: dict[int, list[Check]] = {}
    branches: list[DataFrame] = []
    for check in checks:
        if check.row_condition is not None:
            by_table.setdefault(id(check.df), []).append(check)
            continue
        n = F.sum("n_rows") if check.kind == "relationships" else F.count(F.lit(1))
        branches.append(
            check.violations()
            .agg(F.coalesce(n, F.lit(0)).cast("bigint").alias("failing_rows"))
            .select(F.lit(check.name).alias("check_name"), "failing_rows")
        )
    for group in by_table.values():
        counts = group[0].df.agg(*[F.count_if(c.row_condition).alias(c.name) for c in group])
        pairs = [
            F.struct(F.lit(c.name).alias("check_name"), F.col(f"`{c.name}`").alias("failing_rows")) for c in group
        ]
        branches.append(counts.select(F.explode(F.array(*pairs)).alias("c")).select("c.*"))
    out = branches[0]
    for branch in branches[1:]:
        out = out.unionByName(branch)
    return out


class GateError(RuntimeError):
    """At least one check failed; later stages must not run."""

    def __init__(self, failed: dict[str, int]):
        super().__init__("failed checks: " + ", ".join(f"{k} ({v})" for k, v in sorted(failed.items())))
        self.failed = failed


def gate(results: DataFrame) -> dict[str, int]:
    """Evaluate all checks in one action and raise if any failed. Collects one row per check."""
    counts = {r["check_name"]: r["failing_rows"] for r in results.collect()}
    failed = {name: n for name, n in counts.items() if n}
    if failed:
        raise GateError(failed)
    return counts


def preview(violations: DataFrame, order: list[str], n: int = PREVIEW_ROWS) -> DataFrame:
    """The first violating rows by ``order``, which other columns break ties of, so that everybody sees the same ones."""
    return violations.orderBy(*order, *tie_breakers(violations, set(order))).limit(n)


def quarantine(df: DataFrame, violations: DataFrame, key: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(good, bad): the rows without and with a violating key."""
    return drop_keys(df, violations, key), keep_keys(df, violations, key)


def freshness(
    watermarks: DataFrame,
    schemas: list[str],
    now: datetime,
    warn_hours: float = WARN_HOURS,
    error_hours: float = ERROR_HOURS,
) -> DataFrame:
    """Status of the last sync per schema: pass, warn or error; a schema without a sync is an error."""
    spark = watermarks.sparkSession
    expected = spark.createDataFrame([(s,) for s in schemas], "bronze_schema string")
    last = watermarks.groupBy("bronze_schema").agg(F.max("synced_at").cast("timestamp_ntz").alias("synced_at"))
    aged = freshness_status(expected.join(last, "bronze_schema", "left"), now, warn_hours, error_hours)
    return aged


def freshness_status(
    last_syncs: DataFrame, now: datetime, warn_hours: float = WARN_HOURS, error_hours: float = ERROR_HOURS
) -> DataFrame:
    """Add ``age_seconds`` and ``status`` to rows of (bronze_schema, synced_at)."""
    age = F.timestamp_diff("SECOND", F.col("synced_at").cast("timestamp"), utc_literal(now).cast("timestamp"))
    status = (
        F.when(F.col("age_seconds").isNull() | (F.col("age_seconds") > error_hours * 3600), "error")
        .when(F.col("age_seconds") > warn_hours * 3600, "warn")
        .otherwise("pass")
    )
    return last_syncs.withColumn("age_seconds", age).withColumn("status", status)
