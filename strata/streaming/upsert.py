"""Streaming upsert: newest row per key, kept up to date from a stream of change rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from strata.operators.conform import require_not_null
from strata.operators.dedupe import UNORDERABLE, latest_per_key
from strata.operators.joins import drop_keys, keep_keys
from strata.sources.store import PART, TableStore, key_bucket


def newest(target: DataFrame | None, batch: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """The rows to write for a batch: per batch key the newest of the batch and the stored row, so that
    a late row never replaces a newer one."""
    if target is None:
        return latest_per_key(batch, keys, order_cols)
    contested = keep_keys(target, batch, keys, nulls_match=True).unionByName(batch, allowMissingColumns=True)
    return latest_per_key(contested, keys, order_cols)


def apply_batch(
    store: TableStore,
    table: str,
    batch: DataFrame,
    keys: list[str],
    order_cols: list[str],
    buckets: int | None = None,
    part: Column | None = None,
    skip_redelivered: bool = False,
) -> DataFrame:
    """Merge one batch into the stored table. Applying the same batch again changes nothing.

    With ``skip_redelivered`` rows that are stored already, alike in all columns, are left out before partitions are
    rewritten. With ``buckets`` of the key only those of the batch's keys are read, compared and rewritten. With ``part`` rows
    move between partitions as their values change, so a batch's keys are looked up in all of them.
    """
    fresh = store.stage(f"{table}/arriving", latest_per_key(require_not_null(batch, keys), keys, order_cols))
    target = stored_counterparts(store, table, fresh, keys, buckets)
    rows = newest(target, fresh, keys, order_cols)
    if skip_redelivered and target is not None:
        shared = [f.name for f in rows.schema.fields if f.name in target.columns and not isinstance(f.dataType, UNORDERABLE)]
        rows = drop_keys(rows, target, shared, nulls_match=True)
    return store.merge(table, rows, keys, part, buckets=buckets)


def stored_counterparts(store: TableStore, table: str, batch: DataFrame, keys: list[str], buckets: int | None) -> DataFrame | None:
    """The part of the stored table in which rows of the batch's keys can lie; all of it where it isn't stored in so many buckets."""
    if not store.exists(table):
        return None
    if buckets and all(p.endswith(f"-of-{buckets}") for p in store.partitions(table) or [""]):
        return store.read_parts(table, batch.select(key_bucket(keys, buckets).alias(PART))).drop(PART)
    return store.read(table)


def stream_upsert(
    stream: DataFrame,
    store: TableStore,
    table: str,
    keys: list[str],
    order_cols: list[str],
    checkpoint: str,
    buckets: int | None = None,
    part: Column | None = None,
    skip_redelivered: bool = False,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the upsert of a change stream into a stored table.

    ``foreachBatch`` may replay a batch after a failure; :func:`apply_batch` is idempotent. However late a row is, it
    is merged. In ``buckets`` of the key a batch rewrites only those it touches; with ``skip_redelivered`` rows stored
    already touch none.
    """

    def write(batch: DataFrame, _: int) -> None:
        apply_batch(store, table, batch, keys, order_cols, buckets, part, skip_redelivered)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
