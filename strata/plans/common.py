"""What the three jobs share: load, freshness, gates, publication and tidying up, in stage order."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from functools import partial, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from strata import columns as names
from strata.operators.incremental import rows_that_differ
from strata.operators.quality import Check, GateError, freshness, gate, run_checks
from strata.session import lean, settings, small_splits
from strata.sources.landing import Sync, record_watermark, sync_table, watermark_row
from strata.sources.publish import PublishSpec, publication_scope, publish
from strata.sources.store import PART, TableStore, part_text, store_failures


@dataclass
class Report:
    """What a run did: stage names in order, check results, published row counts.

    ``sync`` is the watermark that a load wrote, ``late`` counts the rows per fact that lie before the slice of this run
    although the fact lacks them or holds other values; a full refresh brings them in.
    """

    stages: list[str] = field(default_factory=list)
    checks: dict[str, int] = field(default_factory=dict)
    published: dict[str, dict] = field(default_factory=dict)
    late: dict[str, int] = field(default_factory=dict)
    sync: dict[str, object] | None = None


def job(run: Callable[..., Report]) -> Callable[..., Report]:
    """A job over (sources, store, ...), whose steps write what others read, with the settings for that."""

    @wraps(run)
    def with_settings(sources: object, store: TableStore, *args, **options) -> Report:
        with settings(store.spark, lean(store.spark)):
            return run(sources, store, *args, **options)

    return with_settings


def together(spark: SparkSession, steps: list[Callable[[], object]]) -> list:
    """Results of steps that don't need one another, run at the same time: while one waits for its last tasks or the driver, the
    others use the executors. All have ended when an error of one is raised."""
    with ThreadPoolExecutor(max(len(steps), 1)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [s.result() for s in started]


def load(
    store: TableStore, schema: str, sources: dict[str, DataFrame], syncs: dict[str, Sync], run_ts: datetime, report: Report
) -> dict[str, DataFrame]:
    """The load stage: each source is synced as ``syncs`` says, then the sync is logged.

    Returns the landed tables. The watermark counts the rows that were read and those kept of them, one per key.
    """
    steps = [partial(sync_table, store, f"{schema}/{name}", df, syncs[name], run_ts) for name, df in sources.items()]
    synced = dict(zip(sources, together(store.spark, steps), strict=True))
    read, kept = (sum(getattr(s, n) for s in synced.values()) for n in ("emitted", "committed"))
    row = watermark_row(store.spark, schema, f"load-{schema}", run_ts, records_emitted=read, records_committed=kept)
    record_watermark(store, row)
    report.sync = row.first().asDict()
    report.stages.append("load")
    return {name: s.table for name, s in synced.items()}


class StaleSourceError(RuntimeError):
    """The last sync is older than the error limit, or none was recorded."""


def require_fresh(watermarks: DataFrame | None, schema: str, now: datetime, report: Report) -> None:
    """Stop the run when the schema's last sync is too old. Without a sync log the stage is skipped."""
    if watermarks is None:
        return
    row = freshness(watermarks, [schema], now).first()
    if row["status"] == "error":
        raise StaleSourceError(f"{schema}: last sync {row['synced_at']}")
    report.stages.append(f"freshness {row['status']}")


def pass_gate(
    stage: str,
    checks: list[Check],
    report: Report,
    store: TableStore,
    run_ts: datetime,
    keep_failures: bool,
) -> None:
    """Run the checks as one query; on failure keep the failing rows and stop the job."""
    try:
        report.checks |= gate(run_checks(checks))
    except GateError as error:
        for check in checks:
            if check.name in error.failed:
                store_failures(store, check.violations(), check.name, run_ts, enabled=keep_failures)
        raise
    report.stages.append(stage)


def late_changes(store: TableStore, fact: str, rows: DataFrame, keys: list[str], at: str, part: Column, days: int) -> DataFrame:
    """Rows that changed lately but lie before the fact's slice, although the fact lacks them or holds other values.

    Of the rows, which carry an extraction time, those are looked at that were extracted after the fact's newest one. Of the fact only the partitions are opened that such rows would lie in: were the stored row elsewhere, it
    would differ. Within these Spark may filter the fact by a Bloom filter of the keys.
    """
    stored = store.read(fact)
    bound = F.max(at) - F.expr(f"INTERVAL {int(days)} DAYS")
    marks = stored.agg(bound.cast("string").alias(at), F.max(names.LAST_EXTRACTED_AT).cast("string").alias(names.LAST_EXTRACTED_AT)).first()
    if marks[at] is None:
        return rows.limit(0)
    kind = rows.schema[at].dataType
    before = F.coalesce(F.col(at), F.lit("1970-01-01").cast(kind)) < F.lit(marks[at]).cast(kind)
    since = F.col(names.EXTRACTED_AT) > F.lit(marks[names.LAST_EXTRACTED_AT] or "1970-01-01").cast(rows.schema[names.EXTRACTED_AT].dataType)
    changed = store.stage(f"{fact}/late", rows.filter(before & since).drop(names.EXTRACTED_AT))
    there = store.read_parts(fact, changed.select(part_text(part).alias(PART))).drop(PART)
    # said again, the condition tells the optimizer that there are few such keys, so that it filters the fact by them
    return rows_that_differ(changed.filter(before), there, keys)


def count_late(report: Report, store: TableStore, fact: str, rows: DataFrame, keys: list[str], at: str, part: Column, days: int) -> None:
    """Note how many rows of an incremental run are too old for its slice."""
    if store.exists(fact):
        report.late[fact.split("/")[-1]] = late_changes(store, fact, rows, keys, at, part, days).count()


def finish(store: TableStore, report: Report, catalog: dict[str, list[str]] | None = None) -> None:
    """Name the Gold tables in the catalog, with statistics of the given columns.

    ``catalog`` maps stored tables to the columns to analyze; a table ``schema/name`` becomes ``schema.name``.
    """
    for table, columns in (catalog or {}).items():
        schema, name = table.split("/")
        store.spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
        store.publish_to_catalog(table, f"{schema}.{name}", columns)
    report.stages.append("finish")


def publish_all(store: TableStore, schema: str, specs: list[PublishSpec], report: Report) -> None:
    """Publish gold tables and note the scope of each copy."""

    def scope(spec: PublishSpec) -> dict:
        gold = store.read(f"{schema}/{spec.table}")
        copy, rows = publish(store, gold, spec, folder=f"published/{schema}")
        # a capped publication is what this run sent, an uncapped one the whole copy
        sent = publication_scope(copy if spec.max_rows is None else rows, spec.max_rows, spec.source or f"{schema}.{spec.table}")
        return sent.first().asDict()

    with settings(store.spark, small_splits(store.spark)):
        sent = together(store.spark, [partial(scope, s) for s in specs])
    report.published |= dict(zip([s.table for s in specs], sent, strict=True))
    report.stages.append("publish")
