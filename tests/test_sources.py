from __future__ import annotations

import json
import os
import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import columns as names
from strata.operators.dedupe import latest_per_key
from strata.operators.joins import drop_keys
from strata.plans.bronze import Tables
from strata.plans.registry import monitoring
from strata.session import lean, settings
from strata.sources import generate, landing, publish, runlog
from strata.sources import store as store_module
from strata.sources.publish import PublishSpec
from strata.sources.readers import SourceSpec, explode_records, read_json_records, read_source
from strata.sources.store import TableStore, bucket_table, layout
from tests.util import plan, rows, ts

SCHEMA = "id long, at timestamp_ntz, v string"


def frame(spark, *data):
    return spark.createDataFrame([(i, ts(at), v) for i, at, v in data], SCHEMA)


def month():
    return F.date_format("at", "yyyy-MM")


# ---- store


def test_overwrite_reading_itself(spark, store):
    store.overwrite("t", frame(spark, (1, "2024-01-01", "a")))
    store.overwrite("t", store.read("t").unionByName(frame(spark, (2, "2024-01-01", "b"))), ["id"])
    assert rows(store.read("t"), "id") == [(1,), (2,)]


def test_what_a_failed_run_left_is_invisible(spark, store):
    store.overwrite("t", frame(spark, (1, "2024-01-01", "a")), ["id"], month())
    for folder in ("_swap/t.new/_part=2024-09", "t/.spark-staging-x/_part=2024-01"):
        os.makedirs(f"{store.root}/{folder}")
        with open(f"{store.root}/{folder}/part-0.parquet", "w") as f:
            f.write("half a file")
    assert store.read("t").count() == 1
    store.overwrite("t", frame(spark, (1, "2024-01-01", "a"), (2, "2024-01-01", "b")), ["id"], month())
    assert store.partitions("t") == ["2024-01"]
    assert TableStore(spark, store.root).read("t").count() == 2
    # a run that ended between its two renames
    os.rename(f"{store.root}/t", f"{store.root}/_swap/t.old")
    assert TableStore(spark, store.root).read("t").count() == 2


def files(store, table):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{store.root}/{table}") for f in names if f.endswith(".parquet")}


def touched(store, table, before):
    """Partitions that have other files than before."""
    return sorted({f.split("_part=")[1].split("/")[0] for f in files(store, table) ^ before})


def test_missing_and_empty_tables(spark, store):
    assert not store.exists("none")
    with pytest.raises(FileNotFoundError):
        store.read("none")
    store.overwrite("t", frame(spark), ["id"], month())
    assert store.read("t").count() == 0
    assert store.read("t").columns == ["id", "at", "v"]


def test_merge_rewrites_touched_partitions_only(spark, store):
    first = frame(
        spark,
        (1, "2024-01-05", "a"),
        (2, "2024-02-05", "b"),
        (3, "2024-03-05", "c"),
        (4, "2024-03-06", "d"),
        (5, None, "no month"),
    )
    store.merge("t", first, ["id"], month())
    # 2 moves to April, 4 changes in place, 6 is new
    before = files(store, "t")
    batch = frame(spark, (2, "2024-04-01", "B"), (4, "2024-03-06", "D"), (6, "2024-04-02", "f"))
    got = rows(store.merge("t", batch, ["id"], month()))
    assert [(r[0], r[2]) for r in got] == [(1, "a"), (2, "B"), (3, "c"), (4, "D"), (5, "no month"), (6, "f")]
    assert touched(store, "t", before) == ["2024-02", "2024-03", "2024-04"]
    assert store.partitions("t") == ["2024-01", "2024-03", "2024-04", "none"]
    assert rows(store.merge("t", batch, ["id"], month())) == got


def test_merge_prunes_dead_keys_everywhere(spark, store):
    first = frame(spark, (1, "2024-01-05", "a"), (2, "2024-02-05", "b"), (3, "2024-03-05", "c"))
    store.merge("t", first, ["id"], month())
    alive = spark.createDataFrame([(2,), (3,), (4,)], "key long")
    got = store.merge("t", frame(spark, (4, "2024-03-07", "d")), ["id"], month(), alive=(alive, "key"))
    assert rows(got, "id") == [(2,), (3,), (4,)]
    assert store.partitions("t") == ["2024-02", "2024-03"]


def test_merge_against_brute_force(spark, store):
    rng = random.Random(11)
    table, upstream = {}, set(range(30))

    def at():
        return f"2024-0{rng.randrange(1, 6)}-01"

    for step in range(6):
        batch = {rng.choice(sorted(upstream)): (at(), f"v{step}") for _ in range(6)}
        upstream -= set(rng.sample(sorted(upstream), 3))
        table = {k: v for k, v in {**table, **batch}.items() if k in upstream}
        alive = spark.createDataFrame([(str(k),) for k in upstream], "key string")
        part = month() if rng.random() < 0.8 else None
        frame_ = frame(spark, *[(k, *v) for k, v in batch.items()])
        if step == 0:
            frame_ = frame_.filter(F.col("id").isin(sorted(upstream)))
        got = store.merge("t", frame_, ["id"], part, alive=(alive, "key"))
        assert rows(got) == rows(frame(spark, *[(k, *v) for k, v in table.items()]))


def test_merge_filters_wide_rows_without_shuffling_them(spark, store, monkeypatch):
    wide = spark.range(5000).select("id", F.lit("2024-01-01").cast("timestamp_ntz").alias("at"), F.lit("v").alias("v"))
    store.merge("t", wide, ["id"], month())
    plans = []
    write = TableStore._write
    monkeypatch.setattr(TableStore, "_write", lambda self, path, df, *a, **k: (plans.append(plan(df)), write(self, path, df, *a, **k)))
    store.merge("t", frame(spark, (7, "2024-01-01", "x")), ["id"], month(), alive=(spark.range(4999), "id"))
    (merged,) = plans
    assert "SortMergeJoin" not in merged and "BroadcastHashJoin" in merged
    assert "dynamicpruning" in merged  # only touched folders are opened
    assert store.read("t").count() == 4999


def test_merge_evolves_the_schema(spark, store):
    store.merge("t", frame(spark, (1, "2024-01-05", "a"), (2, "2024-02-05", "b")), ["id"], month())
    batch = frame(spark, (2, "2024-02-05", "B")).withColumn("w", F.lit(1))
    assert rows(store.merge("t", batch, ["id"], month()), "id", "v", "w") == [(1, "a", None), (2, "B", 1)]
    dropped = store.merge("t", batch.drop("v"), ["id"], month(), "sync_all")
    assert dropped.columns == ["id", "at", "w"]
    assert rows(dropped, "id", "w") == [(1, None), (2, 1)]


def test_partitions_come_and_go(spark, store):
    store.merge("t", frame(spark, (1, "2024-01-05", "a"), (2, "2024-02-05", "b"), (3, "2024-03-05", "c")), ["id"], month())
    for i in range(5):
        # 2 moves between months
        store.merge("t", frame(spark, (2, f"2024-0{4 + i}-01", f"b{i}"), (1, "2024-01-05", f"a{i}")), ["id"], month())
    assert rows(store.read("t"), "id", "v") == [(1, "a4"), (2, "b4"), (3, "c")]
    assert store.partitions("t") == ["2024-01", "2024-03", "2024-08"]
    store.merge("t", frame(spark, (2, "2024-02-01", "back")), ["id"], month())
    assert rows(store.read("t"), "id", "v") == [(1, "a4"), (2, "back"), (3, "c")]
    nothing = store.merge("t", frame(spark), ["id"], month(), alive=(spark.range(0), "id"))
    assert nothing.count() == 0 and nothing.columns == ["id", "at", "v"] and TableStore(spark, store.root).read("t").count() == 0


def test_odd_partition_names(spark, store):
    odd = ["a/b", "x=y", "100%", "it's", "", "ü:ö"]
    df = spark.createDataFrame([(i, o) for i, o in enumerate(odd)], "id long, v string")
    store.merge("t", df, ["id"], F.col("v"))
    store.merge("t", df.filter("id < 3").withColumn("v", F.lit("it's")), ["id"], F.col("v"))
    assert rows(store.read("t"), "id", "v") == [(0, "it's"), (1, "it's"), (2, "it's"), (3, "it's"), (4, ""), (5, "ü:ö")]
    store.publish_to_catalog("t", "strata_odd")
    assert rows(spark.table("strata_odd"), "id") == [(i,) for i in range(6)]
    spark.sql("DROP TABLE strata_odd")


def test_another_number_of_buckets_deals_the_table_anew(spark, store):
    landing.load_append_dedup(store, "d", spark.range(50).select("id", F.lit("a").alias("v"), F.lit(1).alias("n")), ["id"], ["n"], buckets=4)
    batch = spark.range(3).select("id", F.lit("b").alias("v"), F.lit(2).alias("n"))
    got = landing.load_append_dedup(store, "d", batch, ["id"], ["n"], buckets=8)
    assert got.count() == 50 and got.filter("v = 'b'").count() == 3
    assert all(p.endswith("-of-8") for p in store.partitions("d"))


def test_catalog_table_follows_the_stored_one(spark, store):
    store.overwrite("t", frame(spark, (1, "2024-01-01", "a")))
    store.publish_to_catalog("t", "strata_t", analyze=["id"])
    store.overwrite("t", frame(spark, (2, "2024-01-01", "b")))
    store.publish_to_catalog("t", "strata_t", analyze=["id"])
    assert rows(spark.table("strata_t"), "id") == [(2,)]
    stats = spark.sql("DESCRIBE EXTENDED strata_t").filter("col_name = 'Statistics'").first()
    assert "1 rows" in stats["data_type"]


def test_catalog_table_of_a_merged_table(spark, store):
    store.merge("t", frame(spark, (1, "2024-01-05", "a"), (2, "2024-02-05", "b")), ["id"], month())
    store.merge("t", frame(spark, (2, "2024-02-06", "B"), (3, "2024-03-05", "c")), ["id"], month())
    store.publish_to_catalog("t", "strata_merged", analyze=["id"])
    assert rows(spark.table("strata_merged"), "id", "v") == [(1, "a"), (2, "B"), (3, "c")]
    store.merge("t", frame(spark, (1, "2024-01-05", "A")), ["id"], month())
    store.publish_to_catalog("t", "strata_merged", analyze=["id"])
    assert rows(spark.table("strata_merged"), "id", "v") == rows(store.read("t"), "id", "v") == [(1, "A"), (2, "B"), (3, "c")]
    spark.sql("DROP TABLE strata_merged")


def test_merging_few_keys_rewrites_few_buckets(spark, store):
    store.merge("t", spark.range(500).select("id", F.lit("x").alias("v")), ["id"], buckets=16)
    before = files(store, "t")
    store.merge("t", spark.range(3).select("id", F.lit("y").alias("v")), ["id"], buckets=16)
    assert 1 <= len(touched(store, "t", before)) <= 3
    assert dict(rows(store.read("t").groupBy("v").count())) == {"x": 497, "y": 3}


def test_null_keys_merge_like_others(spark, store):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "id long, v string")
    for buckets in (None, 4):
        for _ in range(3):
            store.merge(f"t{buckets}", df, ["id"], buckets=buckets)
        assert store.read(f"t{buckets}").count() == 2


def test_an_empty_batch_still_reshapes(spark, store):
    store.merge("t", frame(spark, (1, "2024-01-05", "a")), ["id"], month())
    got = store.merge("t", frame(spark).drop("v"), ["id"], month(), on_schema_change="sync_all")
    assert got.columns == ["id", "at"] and got.count() == 1
    got = store.merge("t", frame(spark).withColumn("w", F.lit(1)), ["id"], month())
    assert set(got.columns) == {"id", "at", "v", "w"} and got.count() == 1


def test_layout_narrows_files(spark, tmp_path):
    path = str(tmp_path / "sorted")
    layout(spark.range(10_000).select((F.col("id") * 7919 % 10_000).alias("id")), ["id"]).write.parquet(path)
    spans = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("id").alias("a"), F.max("id").alias("b"))
    spans = sorted((r["a"], r["b"]) for r in spans.collect())
    assert all(x[1] < y[0] for x, y in zip(spans, spans[1:], strict=False))


# ---- reading and landing


@pytest.mark.parametrize("wrap", [None, "data", "value", "result"])
def test_json_records(spark, tmp_path, wrap):
    records = [{"countryid": "1", "country": "A"}, {"countryid": "2", "country": "B"}]
    body = records if wrap is None else {"next": "x", wrap: records}
    path = tmp_path / "api.json"
    path.write_text(json.dumps(body, indent=1))
    assert rows(read_json_records(spark, str(path)), "countryid", "country") == [("1", "A"), ("2", "B")]
    schema = T.StructType([T.StructField("countryid", T.StringType()), T.StructField("country", T.StringType())])
    assert rows(read_json_records(spark, str(path), wrap, schema)) == [("1", "A"), ("2", "B")]


@pytest.mark.parametrize("wrap", [None, "data", "value", "result"])
def test_json_records_with_schema_and_no_selector(spark, tmp_path, wrap):
    records = [{"countryid": "1", "country": "A"}, {"countryid": "2", "country": None}]
    path = tmp_path / "api.json"
    path.write_text(json.dumps({wrap: records} if wrap else records))
    schema = T.StructType([T.StructField("countryid", T.StringType()), T.StructField("country", T.StringType())])
    assert rows(read_json_records(spark, str(path), schema=schema)) == [("1", "A"), ("2", None)]
    path.write_text(json.dumps({"elsewhere": records}))
    with pytest.raises(Exception, match="no records"):
        read_json_records(spark, str(path), schema=schema).collect()


def test_json_schema_with_a_column_named_like_a_selector(spark, tmp_path):
    path = tmp_path / "api.json"
    path.write_text('[{"id": 1, "value": "x"}, {"id": 2, "value": null}]')
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("value", T.StringType())])
    assert rows(read_json_records(spark, str(path), schema=schema)) == [(1, "x"), (2, None)]


def test_json_records_that_are_all_null(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    for body in ('[{"id": 1, "name": "x"}, {"id": null, "name": null}, {}]', '{"data": [{"id": 1, "name": "x"}, {"id": null}, {"other": 3}]}'):
        path = tmp_path / "api.json"
        path.write_text(body)
        assert rows(read_json_records(spark, str(path), schema=schema)) == [(1, "x"), (None, None), (None, None)]
    path.write_text('{"id": null, "name": null}')
    assert rows(read_json_records(spark, str(path), schema=schema)) == [(None, None)]


def test_json_single_object(spark, tmp_path):
    path = tmp_path / "one.json"
    path.write_text('{"countryid": "1", "country": "A"}')
    assert rows(read_json_records(spark, str(path)), "countryid") == [("1",)]


def test_explode_records_keeps_other_columns(spark):
    df = spark.createDataFrame([(7, '[{"a": 1}, {"a": 2}]'), (8, "[]")], "page long, body string")
    record = T.StructType([T.StructField("a", T.LongType())])
    assert rows(explode_records(df, "body", record)) == [(7, 1), (7, 2)]


def test_read_source_pushes_cursor_and_columns(spark, tmp_path):
    path = str(tmp_path / "src")
    frame(spark, (1, "2024-01-01", "a"), (2, "2024-02-01", "b")).write.parquet(path)
    df = read_source(spark, SourceSpec("src", path=path, columns=["id"], cursor="at", last_value="2024-02-01"))
    assert rows(df) == [(2,)]
    text = plan(df)
    assert "GreaterThanOrEqual(at,2024-02-01" in text
    assert "ReadSchema: struct<id:bigint,at:timestamp_ntz>" in text


def test_stamp_bronze(spark, run_ts):
    df = frame(spark, (1, "2024-01-01", "a"), (2, "2024-01-01", None))
    out = landing.stamp_bronze(df, run_ts)
    assert out.columns[-3:] == [names.RAW_ID, names.EXTRACTED_AT, names.META]
    assert out.select(names.RAW_ID).distinct().count() == 2
    assert rows(landing.stamp_bronze(df, run_ts, ["id"]), names.RAW_ID) == rows(
        landing.stamp_bronze(df.repartition(3), run_ts, ["id"]), names.RAW_ID
    )
    assert {tuple(r) for r in rows(out, names.EXTRACTED_AT, names.META)} == {(run_ts, "{}")}


def test_load_modes(spark, store, run_ts):
    landing.load_overwrite(store, "c", frame(spark, (1, "2024-01-01", "a")))
    landing.load_overwrite(store, "c", frame(spark, (2, "2024-01-01", "b")))
    assert rows(store.read("c"), "id") == [(2,)]
    landing.load_append_dedup(store, "d", frame(spark, (1, "2024-01-02", "a"), (2, "2024-01-01", "b")), ["id"], ["at"], 4)
    batch = frame(spark, (1, "2024-01-01", "older"), (2, "2024-01-03", "newer"), (3, "2024-01-01", "c"))
    for _ in range(2):
        landing.load_append_dedup(store, "d", batch, ["id"], ["at"], 4)
        assert rows(store.read("d"), "id", "v") == [(1, "a"), (2, "newer"), (3, "c")]
    copies = landing.snapshot_copy(store, {"x": store.read("c"), "y": store.read("d")}, "src", run_ts)
    assert {k: v.count() for k, v in copies.items()} == {"x": 1, "y": 3}
    assert names.RAW_ID in store.read("src/x").columns


def test_watermarks(spark, store, run_ts):
    for i, job in enumerate([11, 12]):
        row = landing.watermark_row(spark, "src_a", "c", run_ts + timedelta(days=i), "p", job, 5, 4)
        landing.record_watermark(store, row)
    landing.record_watermark(store, landing.watermark_row(spark, "src_b", "c", run_ts))
    got = rows(store.read(landing.WATERMARKS), "bronze_schema", "job_id", "synced_at")
    assert got == [("src_a", 12, run_ts + timedelta(days=1)), ("src_b", None, run_ts)]
    with pytest.raises(ValueError):
        landing.watermark_row(spark, " ", "c", run_ts)


def test_run_if_empty(spark):
    df = frame(spark, (1, "2024-01-01", "a"))
    assert landing.run_if_empty(df, lambda: df.union(df)).count() == 1
    assert landing.run_if_empty(df.filter("false"), lambda: df.union(df)).count() == 2


# ---- generator


def test_generated_orders(spark, run_ts):
    orders = generate.gen_orders(spark, 20_000, 42, run_ts)
    stats = orders.agg(
        F.count("*"), F.countDistinct("customer_id"), F.min("amount"), F.max("amount"), F.min("order_date"), F.max("order_date")
    ).first()
    assert stats[0] == 20_000
    assert stats[1] == 20
    assert Decimal("10.00") <= stats[2] < Decimal("11") and Decimal("509") < stats[3] <= Decimal("510.00")
    assert run_ts - timedelta(days=364) <= stats[4] and stats[5] <= run_ts
    cancelled = orders.filter("status = 'cancelled'").count()
    assert 800 < cancelled < 1200
    same = generate.gen_orders(spark, 20_000, 42, run_ts).repartition(3)
    assert orders.exceptAll(same).count() == 0
    assert orders.schema["amount"].dataType == T.DecimalType(10, 2)


def test_generated_sap(spark):
    sap = generate.gen_sap(spark, 7, date(2024, 3, 1))
    counts = {k: v.count() for k, v in sap.items()}
    assert counts["sap_material"] == 12 and counts["sap_business_partner"] == 12 and counts["sap_sales_order"] == 216
    assert 216 <= counts["sap_sales_order_item"] <= 648
    orders, items = sap["sap_sales_order"], sap["sap_sales_order_item"]
    assert orders.join(sap["sap_business_partner"], "partner_number", "left_anti").count() == 0
    assert items.join(orders, "sales_order_number", "left_anti").count() == 0
    assert items.join(sap["sap_material"], "material_number", "left_anti").count() == 0
    assert items.groupBy("sales_order_number", "item_number").count().filter("count > 1").count() == 0
    assert items.filter("order_quantity <= 0 OR net_value < 0").count() == 0
    assert items.join(orders.select("sales_order_number", F.col("currency_code").alias("c")), "sales_order_number").filter(
        "c <> currency_code"
    ).count() == 0


# ---- publishing


def test_published_fields(spark):
    df = spark.createDataFrame(
        [], "a int, b bigint, c smallint, d decimal(18,2), e double, f float, g boolean, h date, i timestamp_ntz, j string, k binary"
    )
    assert [t for _, t in publish.published_fields(df)] == [
        "int", "int", "int", "numeric", "float", "float", "bool", "date", "timestamp", "text", "text",
    ]


def test_records(spark):
    df = spark.createDataFrame(
        [(1, Decimal("1.50"), date(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5), None), (2, None, None, datetime(2024, 1, 2, 0, 0, 0, 120), "x")],
        "id long, d decimal(18,2), day date, at timestamp_ntz, s string",
    )
    assert rows(publish.to_records(df)) == [
        (1, 1.5, "2024-01-02", "2024-01-02T03:04:05", None),
        (2, None, None, "2024-01-02T00:00:00.000120", "x"),
    ]
    first = json.loads(publish.to_json_lines(df).first()["record"])
    assert first == {"id": 1, "d": 1.5, "day": "2024-01-02", "at": "2024-01-02T03:04:05", "s": None}


def test_publish_caps_batches_and_upserts(spark, store):
    spec = PublishSpec("t", ("id",), max_rows=250, batch_rows=10)
    df = spark.range(400).select("id", F.lit("a").alias("v"))
    out, sent = publish.publish(store, df.orderBy(F.desc("id")), spec)
    assert out.count() == 250 and out.agg(F.max("id")).first()[0] == 249
    biggest = out.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert biggest <= 100
    # rows published before stay; rows of the same key are replaced
    scope = publish.publication_scope(sent, 250, "gold.t").first()
    again, sent = publish.publish(store, df.filter("id >= 200").withColumn("v", F.lit("b")), spec)
    assert dict(rows(again.groupBy("v").count())) == {"a": 200, "b": 200}
    # the scope tells of the run, not of the copy
    assert tuple(publish.publication_scope(sent, 250, "gold.t").first()) == ("gold.t", 200, 250, False)
    out = spark.range(250)
    assert tuple(scope) == ("gold.t", 250, 250, True)
    assert not publish.publication_scope(out, 251, "gold.t").first()["is_capped"]
    assert not publish.publication_scope(out.filter("false"), 0, "gold.t").first()["is_capped"]


def test_files_of_an_uncapped_copy_do_not_grow_in_number(spark, store):
    spec = PublishSpec("t", ("id",), batch_rows=100, buckets=2)
    for _ in range(2):
        copy, _ = publish.publish(store, spark.range(3000).repartition(5).select("id", F.lit("a").alias("v")), spec)
        assert copy.count() == 3000 and len(files(store, "published/t")) <= 2 * 8


def test_latest_of_a_stored_frame(spark, store, monkeypatch):
    data = [(i % 40 if i % 13 else None, "x" if i % 3 else None, i) for i in range(120)] + [(1000 + i, "y", i) for i in range(50)]
    df = store.overwrite("t", spark.createDataFrame(data, "a long, b string, v long"))
    want = rows(latest_per_key(df, ["a", "b"], ["v"]))
    assert rows(store.latest("t", df, ["a", "b"], ["v"])) == want
    monkeypatch.setattr(store_module, "SENT_KEYS", 2)
    assert rows(store.latest("t", df, ["a", "b"], ["v"])) == want
    # floats that are equal may differ in bits
    zeros = spark.createDataFrame([(0.0, 1), (-0.0, 2)], "a double, v int")
    assert rows(store.latest("z", zeros, ["a"], ["v"]), "v") == [(2,)]


def test_rows_of_keys_that_do_not_repeat_are_not_shuffled(spark, store):
    df = store.overwrite("t", spark.range(100).select("id", F.lit("a").alias("v")))
    assert "Exchange" not in plan(store.latest("t", df, ["id"], []))
    copy, _ = publish.publish(store, df, PublishSpec("t", ("id",)))
    assert copy.count() == 100


def test_tables_that_compress_well_are_not_broadcast(spark, store):
    store.overwrite("few", spark.range(10))
    store.overwrite("many", spark.range(400_000), ["id"])  # some 600 KB in files, 10 MB and more as rows
    assert "BroadcastExchange" in plan(drop_keys(store.read("many"), store.read("many"), ["id"]))
    with settings(spark, lean(spark)):
        assert "BroadcastExchange" in plan(drop_keys(store.read("many"), store.read("few"), ["id"]))
        assert "BroadcastExchange" not in plan(drop_keys(store.read("many"), store.read("many"), ["id"]))
    assert float(spark.conf.get("spark.sql.sources.fileCompressionFactor")) == 1


def test_merge_looks_for_emptied_partitions_where_no_rows_arrive(spark, store, monkeypatch):
    at = [(1, "2024-01-01", "a"), (2, "2024-02-01", "a"), (3, "2024-03-01", "a"), (4, "2024-03-02", "a")]
    store.overwrite("t", frame(spark, *at), ["id"], month())
    opened, read = [], store.read_parts
    monkeypatch.setattr(store, "read_parts", lambda table, parts: opened.append(rows(parts.distinct())) or read(table, parts))
    store.merge("t", frame(spark, (1, "2024-01-05", "b"), (2, "2024-02-05", "b")), ["id"], month())
    assert opened == [[("2024-01",), ("2024-02",)]]  # for the rows that stay, not once more for those that are left
    # 1 and 3 move to February: January gets empty, March keeps 4
    store.merge("t", frame(spark, (1, "2024-02-06", "c"), (3, "2024-02-07", "c")), ["id"], month())
    assert rows(store.read("t"), "id", "v") == [(1, "c"), (2, "b"), (3, "c"), (4, "a")]
    assert store.partitions("t") == ["2024-02", "2024-03"] and opened[-1] == [("2024-01",), ("2024-03",)]
    # a row without a key is not written where keys have to be alive upstream, so its month does not stay for it
    alive = (spark.createDataFrame([(1,), (2,), (3,)], "id long"), "id")
    store.merge("t", frame(spark, (None, "2024-03-09", "d")), ["id"], month(), alive=alive)
    assert rows(store.read("t"), "id") == [(1,), (2,), (3,)] and store.partitions("t") == ["2024-02"]


def test_publish_keys(spark):
    for keys in ((), "id"):
        with pytest.raises(ValueError, match="keys"):
            PublishSpec("t", keys)


def test_publish_all_rows_null_keys_and_new_columns(spark, store):
    spec = PublishSpec("t", ("a", "b"))
    df = spark.createDataFrame([(1, None, "x"), (None, None, "y"), (2, "z", "w")], "a long, b string, v string")
    for _ in range(3):
        copy, sent = publish.publish(store, df, spec)
        assert copy.count() == sent.count() == 3
    assert tuple(publish.publication_scope(sent, None, "s").first()) == ("s", 3, None, False)
    more = df.filter("a = 1").withColumn("n", F.lit(7))
    assert rows(publish.publish(store, more, spec)[0], "a", "v", "n") == [(1, "x", 7), (2, "w", None), (None, "y", None)]


def test_export_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    publish.export_csv(frame(spark, (1, "2024-01-01 10:00:00", 'say "hi", you'), (2, None, None)), path)
    back = spark.read.option("header", True).option("escape", "\\").csv(path)
    assert rows(back) == [("1", "2024-01-01T10:00:00", 'say "hi", you'), ("2", None, None)]


def test_repeated_loads_with_null_keys(spark, store):
    batch = frame(spark, (1, "2024-01-01", "a"), (None, "2024-01-01", "b"), (None, "2024-01-02", "c"))
    for _ in range(3):
        got = landing.load_append_dedup(store, "t", batch, ["id"], ["at"], 4)
    assert rows(got, "id", "v") == [(1, "a"), (None, "c")]


def test_derived_raw_ids_repeat(spark, run_ts):
    df = frame(spark, (1, "2024-01-01", "a"), (2, None, None))
    first, again = (rows(landing.stamp_bronze(df, run_ts), "id", names.RAW_ID) for _ in range(2))
    assert first == again and len({r[1] for r in first}) == 2
    assert all(len(r[0]) == 36 for r in landing.stamp_bronze(df, run_ts, random_ids=True).select(names.RAW_ID).collect())


# ---- run logs


FAILING = """[2024-03-01 10:00:00] {bash.py:10} INFO - \x1b[31mFailure in test relationships_orders_customer_id (models/staging/_staging.yml)\x1b[0m
[2024-03-01 10:00:00] {bash.py:10} INFO -   Got 1 result, configured to fail if != 0
[2024-03-01 10:00:00] {bash.py:10} INFO -
[2024-03-01 10:00:00] {bash.py:10} INFO -   compiled code at target/relationships.sql
[2024-03-01 10:00:01] {bash.py:10} INFO - Failure in test unique_stg_customers_email (models/staging/_staging.yml)
[2024-03-01 10:00:01] {bash.py:10} INFO -   Got 3 results, configured to fail if != 0
[2024-03-01 10:00:02] {bash.py:10} INFO - Done. PASS=10 WARN=0 ERROR=2 SKIP=1 TOTAL=13
"""


def test_logs_by_lines_equal_whole_logs(spark, tmp_path):
    """Files cut into many splits, entries that go on over several of them, lines ahead of any entry, other line ends."""
    rng, folder = random.Random(7), tmp_path / "logs"
    folder.mkdir()
    parts = [
        "noise " * 20, "[2024-01-01] {t.py:1} INFO - \x1b[31mFailure in test unique_a_b (models/a.yml)\x1b[0m", "  Got 3 results", "compiled code at target/a.sql\r",
        "Failure in test not_null_x", "", "Source 'raw.orders'", "  has EXCEEDED its limit", "Source 'raw.parts' is fine", "1 of 2 == [model_a] FAIL", "2 of 2 == [model_b] OK",
        "Database Error", "  relation is missing", "Done. PASS=3 WARN=1 ERROR=0 SKIP=0 TOTAL=4", "Done. PASS=9 ERROR=1",
    ]
    for n in range(12):
        lines = [rng.choice(parts) for _ in range(rng.randrange(1, 120))]
        (folder / f"run{n}.log").write_text("\n".join(lines) + ("\n" if n % 2 else ""))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        lines = runlog.read_log_lines(spark, str(folder)).cache()
        assert lines.select("run", "block").distinct().count() > 40
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    whole = runlog.read_run_logs(spark, str(folder))
    name = F.regexp_extract("run", "run(\\d+)", 0)
    for by_line, by_log in ((runlog.failed_checks_of_lines, runlog.failed_checks), (runlog.run_totals_of_lines, runlog.run_totals)):
        got, want = by_line(lines).withColumn("run", name), by_log(whole).withColumn("run", name)
        assert rows(got, *sorted(got.columns)) == rows(want, *sorted(got.columns))


def test_log_splits_do_not_grow_in_number(spark):
    """Splits of 2 kB were one task each, whatever the logs' size: 790 here."""
    lines = monitoring.in_small_splits(Tables(spark, "/root/testdata/sf0.01"))
    blocks = lines.select("run", "block").distinct()
    assert monitoring.LOG_FILES * 5 < blocks.count() <= monitoring.LOG_FILES * (monitoring.LOG_SPLITS + 1)
    assert blocks.groupBy("run").count().filter("count < 2").isEmpty()
    logs = monitoring.run_logs(Tables(spark, "/root/testdata/sf0.01"))
    got, want = runlog.failed_checks_of_lines(lines).drop("run", "block"), runlog.failed_checks(logs).drop("run", "block")
    assert want.count() > 0 and rows(got, *want.columns) == rows(want, *want.columns)


def test_mining_run_logs(spark, tmp_path):
    logs = {
        "run1/ok.log": "Done. PASS=12 WARN=0 ERROR=0 SKIP=0 TOTAL=12\n",
        "run2/failing.log": FAILING,
        "run3/stale.log": "Source 'bronze_meta.watermark' freshness\n ERROR STALE\n",
        "run4/model.log": "== [fct_orders] FAIL\nDatabase Error\n  division by zero\n",
        "run5/warned.log": "Done. PASS=12 WARN=2 ERROR=0 SKIP=0 TOTAL=14\n",
        "run6/late.log": "Source 'far' " + "checked " * 100 + "\n" + "more " * 100 + "\nmax age EXCEEDED\nDone. PASS=1 WARN=0 ERROR=0\n",
        "run7/fresh.log": "Source 'an_error_log' is fresh\nDone. PASS=1 WARN=0 ERROR=0 SKIP=0 TOTAL=1\n",
    }
    for name, text in logs.items():
        path = tmp_path / name
        path.parent.mkdir()
        path.write_text(text)
    df = runlog.read_run_logs(spark, str(tmp_path)).withColumn("run", F.regexp_extract("run", r"(run\d)", 1))
    failed = rows(runlog.failed_checks(df), "run", "block", "test_name", "result_line", "compiled_path", "test_type")
    assert failed == [
        ("run2", 0, "relationships_orders_customer_id", "Got 1 result, configured to fail if != 0"[4:], "target/relationships.sql", "relationships"),
        ("run2", 1, "unique_stg_customers_email", "3 results, configured to fail if != 0", None, "unique"),
    ]
    totals = runlog.run_totals(df)
    assert dict(rows(totals, "run", "state")) == {
        "run1": "success", "run2": "failed", "run3": "failed", "run4": "failed", "run5": "warned",
        "run6": "failed", "run7": "success",
    }
    assert rows(totals.filter("run = 'run4'"), "failed_model", "database_error") == [("fct_orders", "division by zero")]
    assert rows(totals.filter("run = 'run3'"), "stale_source") == [("bronze_meta.watermark",)]
    assert rows(totals.filter("run = 'run6'"), "stale_source", "n_pass", "n_total") == [("far", 1, None)]
    assert dict(rows(runlog.count_by_state(totals), "state", "n_runs")) == {"failed": 4, "success": 2, "warned": 1}
