"""Landing raw tables and keeping the log of syncs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import columns as names
from strata.functions.time import utc_literal
from strata.operators.dedupe import latest_per_key
from strata.operators.incremental import read_incremental, upsert
from strata.sources.store import TableStore, key_bucket
from strata.streaming.upsert import newest, stored_counterparts

WATERMARK_SCHEMA = T.StructType(
    [
        T.StructField("bronze_schema", T.StringType()),
        T.StructField("connection_id", T.StringType()),
        T.StructField("pipeline_id", T.StringType()),
        T.StructField("synced_at", T.TimestampNTZType()),
        T.StructField("job_id", T.LongType()),
        T.StructField("records_emitted", T.LongType()),
        T.StructField("records_committed", T.LongType()),
    ]
)
WATERMARKS = "bronze_meta/sync_watermarks"


def stamp_bronze(
    df: DataFrame, run_ts: datetime, id_from: list[str] | None = None, random_ids: bool = False
) -> DataFrame:
    """Add raw id, extraction time and empty metadata.

    The id derives from the columns ``id_from``, by default from the whole row, so that it stays the same when a lost
    task is run again; rows alike in these columns share it. ``random_ids`` gives every row a new one instead.
    """
    if random_ids:
        raw_id = F.uuid()
    elif id_from:
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in id_from]
        raw_id = F.md5(F.concat_ws("|", *parts))
    else:
        raw_id = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}))
    return df.select(
        "*", raw_id.alias(names.RAW_ID), utc_literal(run_ts).alias(names.EXTRACTED_AT), F.lit("{}").alias(names.META)
    )


def load_overwrite(store: TableStore, table: str, df: DataFrame) -> DataFrame:
    """full_refresh + overwrite."""
    return store.overwrite(table, df)


def load_append_dedup(
    store: TableStore, table: str, batch: DataFrame, keys: list[str], cursor: list[str], buckets: int
) -> DataFrame:
    """incremental + append_dedup: the stored table keeps the newest row per key.

    It is stored in ``buckets`` of the key, of which a load reads and rewrites those that its own keys fall in. A load with
    another count deals the table anew.
    """
    fresh = store.stage(f"{table}/arriving", latest_per_key(batch, keys, cursor))
    target = stored_counterparts(store, table, fresh, keys, buckets)
    return store.merge(table, newest(target, fresh, keys, cursor), keys, buckets=buckets)


@dataclass(frozen=True)
class Sync:
    """How a source table is synced. With a ``cursor`` incrementally: rows from the stored cursor's largest value on are read
    and the newest row per key stays. Without one the whole table is read and replaces the stored one."""

    keys: tuple[str, ...] = ()
    cursor: str | None = None
    buckets: int = 16


@dataclass(frozen=True)
class Synced:
    """A landed table, the rows that were read from the source and kept of them, and NULLs among them by column."""

    table: DataFrame
    emitted: int
    committed: int
    nulls: dict[str, int]


def sync_table(
    store: TableStore, table: str, source: DataFrame, how: Sync, run_ts: datetime, required: list[str] | None = None
) -> Synced:
    """Land one source table; rows without an extraction time are stamped.

    The source is read once: its rows, and the NULLs of ``required`` columns, are counted while they are written. Rows that
    hold exactly the largest cursor value are read again by the next sync, as others may share it; the key drops them. Rows
    whose cursor is NULL are read by the first sync only.
    """
    if how.cursor and not how.keys:
        raise ValueError(f"{table}: a sync by cursor needs a key")
    if how.cursor and store.exists(table):
        mark = store.read(table).agg(F.max(how.cursor).cast("string")).first()[0]
        source = source if mark is None else read_incremental(source, how.cursor, mark)
    stamped = source if names.EXTRACTED_AT in source.columns else stamp_bronze(source, run_ts)
    seen, kept = Observation(), Observation()
    missing = {c: F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(required or [])}
    counted = stamped.observe(seen, F.count(F.lit(1)).alias("n"), *missing.values())
    if how.cursor:
        keys, order = list(how.keys), [how.cursor, names.EXTRACTED_AT]
        arrived = latest_per_key(store.stage(f"{table}/arriving", counted), keys, order).observe(kept, F.count(F.lit(1)).alias("n"))
        if store.exists(table):
            landed = _merge_newest(store, table, store.stage(f"{table}/fresh", arrived), keys, order, how.buckets)
        else:
            landed = store.overwrite(table, arrived, keys, buckets=how.buckets, dealt=True)
    else:
        landed = load_overwrite(store, table, counted)
    found = seen.get
    nulls = {c: found[f"null_{i}"] for i, c in enumerate(missing)}
    return Synced(landed, found["n"], kept.get["n"] if how.cursor else found["n"], nulls)


def _merge_newest(store: TableStore, table: str, fresh: DataFrame, keys: list[str], order: list[str], buckets: int) -> DataFrame:
    """Bring rows, one per key, into a table that holds one per key; the newer one stays.

    Stored rows of the touched buckets meet the fresh ones in one ranking, whose rows go to their buckets from there. Where the
    columns or the number of buckets differ, the table is merged by key instead, which rewrites it.
    """
    target = stored_counterparts(store, table, fresh, keys, buckets)
    kinds = [{f.name: f.dataType for f in df.schema.fields} for df in (target, fresh)]
    if kinds[0] != kinds[1] or not all(p.endswith(f"-of-{buckets}") for p in store.partitions(table) or [""]):
        return store.merge(table, newest(target, fresh, keys, order), keys, buckets=buckets)
    rows = latest_per_key(target.unionByName(fresh), keys, order)
    return store.replace_parts(table, rows, key_bucket(keys, buckets), [], keys, dealt=True)


def snapshot_copy(
    store: TableStore, tables: dict[str, DataFrame], prefix: str, run_ts: datetime
) -> dict[str, DataFrame]:
    """Copy source tables whole, stamped, replacing the earlier copies."""
    return {
        name: store.overwrite(f"{prefix}/{name}", stamp_bronze(df, run_ts)) for name, df in tables.items()
    }


def watermark_row(
    spark,
    bronze_schema: str,
    connection_id: str,
    synced_at: datetime,
    pipeline_id: str | None = None,
    job_id: int | None = None,
    records_emitted: int | None = None,
    records_committed: int | None = None,
) -> DataFrame:
    if not bronze_schema.strip():
        raise ValueError("bronze_schema is required")
    row = (bronze_schema, connection_id, pipeline_id, synced_at, job_id, records_emitted, records_committed)
    return spark.createDataFrame([row], WATERMARK_SCHEMA)


def merge_watermarks(watermarks: DataFrame | None, rows: DataFrame) -> DataFrame:
    """The log with one row per Bronze schema, the given rows winning."""
    return rows if watermarks is None else upsert(watermarks, rows, ["bronze_schema"])


def record_watermark(store: TableStore, row: DataFrame, table: str = WATERMARKS) -> DataFrame:
    current = store.read(table) if store.exists(table) else None
    return store.overwrite(table, merge_watermarks(current, row))


def run_if_empty(df: DataFrame, seed: Callable[[], DataFrame]) -> DataFrame:
    """The frame itself, or the seed rows when it has none."""
    return seed() if df.isEmpty() else df
