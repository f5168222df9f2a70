from __future__ import annotations

import os

from pyspark.sql import functions as F

from strata.operators.dedupe import latest_per_key
from strata.streaming.cursor_source import CursorReader, read_by_cursor
from strata.streaming.upsert import apply_batch, stream_upsert
from tests.test_sources import files, touched
from tests.util import rows, ts

SCHEMA = "id long, at timestamp_ntz, v string"

DELIVERIES = [
    [(1, "2024-01-01", "a"), (2, "2024-01-05", "b"), (2, "2024-01-04", "older in batch")],
    [(1, "2024-01-02", "a2"), (2, "2024-01-01", "late, must lose"), (3, "2024-01-03", "c"), (None, "2024-01-09", "no key")],
    [(3, "2024-01-03", "c"), (4, "2024-01-06", "d")],
]


def frame(spark, data):
    return spark.createDataFrame([(i, ts(at), v) for i, at, v in data], SCHEMA)


def test_stream_equals_batch(spark, store, tmp_path):
    source, progress = str(tmp_path / "source"), str(tmp_path / "progress")
    os.makedirs(source)
    seen = []
    for delivery in DELIVERIES:
        seen += delivery
        frame(spark, delivery).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        stream_upsert(stream, store, "t", ["id"], ["at"], progress).awaitTermination()
        want = latest_per_key(frame(spark, seen).filter("id is not null"), ["id"], ["at"])
        assert rows(store.read("t")) == rows(want)
    # nothing new: the stream ends without another write
    before = files(store, "t")
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    stream_upsert(stream, store, "t", ["id"], ["at"], progress).awaitTermination()
    assert files(store, "t") == before


def test_replayed_batch_changes_nothing(spark, store):
    for delivery in DELIVERIES:
        apply_batch(store, "t", frame(spark, delivery), ["id"], ["at"], 4)
    before = rows(store.read("t"))
    for delivery in DELIVERIES:
        apply_batch(store, "t", frame(spark, delivery), ["id"], ["at"], 4)
    assert rows(store.read("t")) == before
    assert dict(rows(store.read("t"), "id", "v")) == {1: "a2", 2: "b", 3: "c", 4: "d"}


def test_batch_rewrites_only_its_buckets(spark, store):
    apply_batch(store, "t", spark.range(200).select("id", F.lit(ts("2024-01-01")).cast("timestamp_ntz").alias("at"), F.lit("x").alias("v")), ["id"], ["at"], 16)
    before = files(store, "t")
    apply_batch(store, "t", frame(spark, [(7, "2024-01-02", "y")]), ["id"], ["at"], 16)
    assert len(touched(store, "t", before)) == 1
    assert store.read("t").count() == 200


def test_redelivered_rows_rewrite_nothing_and_late_keys_arrive(spark, store, tmp_path):
    source, before, writes = str(tmp_path / "source"), set(), 0
    for delivery in ([(1, "2024-03-01", "a")], [(9, "2024-03-20", "b")], [(2, "2024-03-02", None)], [(9, "2024-03-20", "b"), (2, "2024-03-02", None)]):
        frame(spark, delivery).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        stream_upsert(
            stream, store, "t", ["id"], ["at"], str(tmp_path / "progress"), 8, skip_redelivered=True
        ).awaitTermination()
        before, writes = files(store, "t"), writes + (files(store, "t") != before)
    assert rows(store.read("t"), "id", "v") == [(1, "a"), (2, None), (9, "b")]
    assert writes == 3


def test_partitions_that_keys_move_between(spark, store):
    """A partition by month derives from no key: a late row of an older month doesn't stay beside the newer one."""
    month = F.date_format("at", "yyyy-MM")
    for delivery in ([(1, "2024-02-05", "b"), (2, "2024-02-06", "x")], [(1, "2024-01-05", "a")], [(2, "2024-03-01", "y")]):
        apply_batch(store, "t", frame(spark, delivery), ["id"], ["at"], part=month)
    assert rows(store.read("t"), "id", "v") == [(1, "b"), (2, "y")]
    assert store.partitions("t") == ["2024-02", "2024-03"]


def test_a_stream_by_cursor_reads_each_row_once(spark, tmp_path):
    """Ties at each bound, a restart from the checkpoint for each step, NULL cursors, and a step without rows."""
    source, sink, progress = (str(tmp_path / n) for n in ("source", "sink", "progress"))
    data = [(i, f"2024-01-{1 + i // 40:02d}", f"v{i}") for i in range(400)]
    cuts = [0, 55, 55, 199, 200, 361, 400]  # 55 and 199 lie amid a day
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a or a == 0:
            frame(spark, data[a:b]).repartition(2).write.mode("append").parquet(source)
        stream = read_by_cursor(spark, source, "at", "id", slices=3)
        assert stream.schema == frame(spark, data[:1]).schema
        query = stream.writeStream.format("parquet").option("checkpointLocation", progress).option("path", sink)
        query.trigger(availableNow=True).start().awaitTermination()
        got = rows(spark.read.schema(SCHEMA).parquet(sink), "id")
        assert sorted(got) == [(i,) for i in range(b)]
    frame(spark, [(999, None, "no cursor")]).write.mode("append").parquet(source)
    read_by_cursor(spark, source, "at", "id").writeStream.format("parquet").option("checkpointLocation", progress).option("path", sink).trigger(
        availableNow=True
    ).start().awaitTermination()
    assert spark.read.parquet(sink).count() == 400
    assert len(CursorReader(["id", "at", "v"], {"path": source, "cursor": "at", "key": "id", "slices": "3"}).partitions({"cursor": None, "key": None}, {"cursor": 1706745600000000, "key": 5})) == 3
