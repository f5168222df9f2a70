"""The three jobs end to end, over several syncs."""

from __future__ import annotations

import threading
import time
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata import columns as names
from strata.operators.incremental import delete_where, upsert
from strata.operators.quality import GateError
from strata.plans import common, countries, retail, sap
from strata.plans.common import StaleSourceError
from strata.sources.generate import (
    drill_duplicate_email,
    drill_orphan_order,
    gen_customer_orders,
    gen_customers,
    gen_sap,
    is_drill_row,
)
from strata.sources.landing import Sync, stamp_bronze, watermark_row
from strata.sources.publish import PublishSpec, to_records
from tests.util import rows

NOW = datetime(2024, 3, 1)


def retail_bronze(spark, customers=6, per=20, now=NOW):
    c = gen_customers(spark, customers, now)
    o = gen_customer_orders(c, per, 3, now)
    return {"customers": stamp_bronze(c, now, ["id"]), "orders": stamp_bronze(o, now, ["id"])}


def written(spark, bronze, folder):
    out = {}
    for name, df in bronze.items():
        path = f"{folder}/{name}"
        df.write.mode("overwrite").parquet(path)
        out[name] = spark.read.parquet(path)
    return out


def comparable(df):
    return df.drop(names.BUILT_AT, names.LAST_EXTRACTED_AT, names.EXTRACTED_AT)


def test_retail_runs_and_reruns(spark, store, tmp_path):
    bronze = written(spark, retail_bronze(spark), tmp_path / "b1")
    log = watermark_row(spark, retail.BRONZE, "c", NOW - timedelta(hours=1))
    report = retail.run_retail(bronze, store, NOW, log)
    assert report.stages == ["freshness pass", "silver", "snapshot", "silver gate", "gold", "gold gate", "publish", "finish"]
    assert not any(report.checks.values())
    assert report.published["fct_orders"]["published_rows"] == 120
    fct = store.read("gold_sales/fct_orders")
    assert fct.schema.simpleString() == retail.FCT_ORDERS_CONTRACT.simpleString()
    mart = store.read("gold_sales/mart_sales_performance")
    total = fct.agg(F.sum("order_amount")).first()[0]
    assert mart.agg(F.sum("total_revenue")).first()[0] == total
    assert mart.agg(F.sum("order_count")).first()[0] == 120
    assert store.read("gold_sales/dim_date").count() == 20

    before = {t: rows(comparable(store.read(t))) for t in ("gold_sales/fct_orders", "gold_sales/mart_sales_performance")}
    retail.run_retail(bronze, store, NOW + timedelta(hours=1))
    assert {t: rows(comparable(store.read(t))) for t in before} == before
    assert store.read("gold_sales/snap_stg_customers").count() == 6


def test_retail_incremental_day(spark, store, tmp_path):
    bronze = written(spark, retail_bronze(spark), tmp_path / "b1")
    retail.run_retail(bronze, store, NOW)
    months = store.partitions("gold_sales/fct_orders")

    # next day: a new order, a changed recent order, a late change to an old one, customer 6 leaves
    day = NOW + timedelta(days=1)
    stamp = F.lit(str(day)).cast("timestamp_ntz")
    orders = bronze["orders"]
    newest = orders.agg(F.max("order_date")).first()[0]
    recent, old = F.col("order_date") == F.lit(str(newest)).cast("timestamp_ntz"), F.col("order_date") < "2024-02-15"
    stays = F.col("customer_id") != 6
    changed = orders.filter(stays).select(
        *[
            F.when((recent | old) & (F.col("customer_id") == 1), F.lit("  CANCELLED ")).otherwise(F.col(c)).alias(c)
            if c == "status"
            else F.when((recent | old) & (F.col("customer_id") == 1), stamp).otherwise(F.col(c)).alias(c)
            if c == names.EXTRACTED_AT
            else F.col(c)
            for c in orders.columns
        ]
    )
    fresh = orders.filter((F.col("customer_id") == 2) & recent).select(
        *[
            (F.lit(10_000).cast(orders.schema["id"].dataType)).alias("id")
            if c == "id"
            else stamp.alias(c)
            if c in ("order_date", names.EXTRACTED_AT)
            else F.col(c)
            for c in orders.columns
        ]
    )
    customers = bronze["customers"].filter("id <> 6")
    second = written(spark, {"customers": customers, "orders": changed.unionByName(fresh)}, tmp_path / "b2")
    report = retail.run_retail(second, store, day)
    assert not any(report.checks.values())

    silver, fct = store.read("silver_sales/stg_orders"), store.read("gold_sales/fct_orders")
    n_old = changed.filter(old & (F.col("customer_id") == 1)).count()
    assert n_old > 0
    assert silver.count() == fct.count() == 101
    assert silver.filter("customer_id = 1 and order_status = 'cancelled'").count() >= n_old + 1
    assert report.late == {"fct_orders": n_old}
    late = silver.alias("s").join(fct.alias("f"), "order_id").filter("s.order_status <> f.order_status")
    assert late.count() > 0
    assert late.filter(F.col("s.order_date") >= "2024-02-27").count() == 0
    assert fct.filter("order_id = 10000").count() == 1
    assert store.read("gold_sales/dim_customer").filter("customer_id = 6").count() == 0
    closed = store.read("gold_sales/snap_stg_customers").filter(F.col(names.SCD_VALID_TO).isNotNull())
    assert rows(closed, "customer_id", names.SCD_VALID_TO) == [(6, day)]
    assert set(months) <= set(store.partitions("gold_sales/fct_orders"))

    # a full refresh brings the late change in
    retail.run_retail(second, store, day + timedelta(hours=1), full_refresh=True)
    silver, fct = store.read("silver_sales/stg_orders"), store.read("gold_sales/fct_orders")
    assert silver.alias("s").join(fct.alias("f"), "order_id").filter("s.order_status <> f.order_status").count() == 0
    assert store.read("gold_sales/dim_date").agg(F.max("date_key")).first()[0] == date(2024, 3, 2)


def test_retail_drill_stops_before_gold(spark, store, tmp_path):
    good = retail_bronze(spark, 4, 5)
    orders = good["orders"].withColumn("customer_id", F.col("customer_id").cast("bigint"))
    stray = stamp_bronze(drill_orphan_order(spark, NOW), NOW)
    twin = stamp_bronze(drill_duplicate_email(spark, " Customer.2@Example.com ", NOW), NOW)
    bad = {
        "customers": upsert(good["customers"].withColumn("id", F.col("id").cast("bigint")), twin, ["id"]),
        "orders": upsert(orders, stray, ["id"]),
    }
    with pytest.raises(GateError) as error:
        retail.run_retail(written(spark, bad, tmp_path / "bad"), store, NOW)
    assert error.value.failed == {
        "unique_stg_customers_email": 1,
        "relationships_source_orders_customer_id": 1,
        "relationships_stg_orders_customer_id": 1,
        "assert_no_orphan_orders_in_silver": 1,
    }
    assert not store.exists("gold_sales/fct_orders")
    kept = store.read("audit/assert_no_orphan_orders_in_silver")
    assert rows(kept, "order_id", "customer_id") == [(900000001, 999999999)]
    # reverted at the source, the next run prunes the rows and goes through
    fixed = {
        "customers": delete_where(bad["customers"], is_drill_row()),
        "orders": delete_where(bad["orders"], is_drill_row("id", "status")),
    }
    report = retail.run_retail(written(spark, fixed, tmp_path / "fixed"), store, NOW + timedelta(hours=2))
    assert report.stages[-2:] == ["publish", "finish"]
    assert store.read("gold_sales/fct_orders").count() == 20


def test_jobs_load_log_and_publish_what_they_built(spark, store):
    c = gen_customers(spark, 5, NOW)
    raw = gen_sap(spark, 11, date(2024, 3, 1), partners=5, orders_per=3)
    land = country(spark, ("g1", "TH", "Thailand", "1", "0", "1", "2024-01-01"))
    jobs = [
        (retail, retail.run_retail({"customers": c, "orders": gen_customer_orders(c, 4, 3, NOW)}, store, NOW, load_sources=True, catalog=True)),
        (sap, sap.run_sap(raw, store, NOW, load_sources=True, catalog=True)),
        (countries, countries.run_countries(land, store, NOW, load_sources=True, catalog=True)),
    ]
    n = 0
    for job, report in jobs:
        assert report.stages[:2] == ["load", "freshness pass"] and report.stages[-2:] == ["publish", "finish"]
        assert report.sync["bronze_schema"] == job.BRONZE and report.sync["records_emitted"] == report.sync["records_committed"] > 0
        for spec in job.PUBLICATIONS:
            gold = store.read(f"{job.GOLD}/{spec.table}")
            assert rows(store.read(f"published/{job.GOLD}/{spec.table}")) == rows(to_records(gold))
            assert spark.table(f"{job.GOLD}.{spec.table}").count() == gold.count()
            n += 1
    assert n == 9
    assert store.read("bronze_meta/sync_watermarks").count() == 3


def test_sources_are_synced_at_the_same_time(spark, store, monkeypatch):
    both, sync = threading.Barrier(2, timeout=60), common.sync_table
    monkeypatch.setattr(common, "sync_table", lambda *a: (both.wait(), sync(*a))[1])
    source = spark.range(3).select("id", F.lit(NOW).cast("timestamp_ntz").alias("at"))
    report = common.Report()
    landed = common.load(store, "s", {"a": source, "b": source}, {"a": Sync(("id",), "at"), "b": Sync()}, NOW, report)
    assert [landed[t].count() for t in "ab"] == [3, 3] and report.sync["records_emitted"] == 6

    def broken():
        raise ValueError("one step")

    with pytest.raises(ValueError, match="one step"):
        common.together(spark, [broken, lambda: 1])


def test_stale_source_stops_the_run(spark, store):
    bronze = retail_bronze(spark, 2, 2)
    with pytest.raises(StaleSourceError):
        retail.run_retail(bronze, store, NOW, watermark_row(spark, retail.BRONZE, "c", NOW - timedelta(hours=49)))
    with pytest.raises(StaleSourceError):
        retail.run_retail(bronze, store, NOW, watermark_row(spark, "other", "c", NOW))
    assert not store.exists("silver_sales/stg_orders")


def test_customers_by_bucket_give_the_same(spark, store, tmp_path):
    bronze = written(spark, retail_bronze(spark, 8, 4), tmp_path / "b")
    report = retail.run_retail(bronze, store, NOW, customer_buckets=4, publications=[])
    assert report.published == {}
    assert len(store.partitions("silver_sales/stg_customers")) > 1
    want = retail.stg_customers(bronze["customers"], None, NOW)
    assert rows(store.read("silver_sales/stg_customers")) == rows(want)


def test_mart_is_exact_when_a_customer_repeats(spark):
    fct = spark.createDataFrame(
        [(1, datetime(2024, 1, 5), Decimal("10.00")), (1, datetime(2024, 1, 6), Decimal("5.01")), (1, datetime(2024, 1, 7), None)],
        "customer_id long, order_date timestamp_ntz, order_amount decimal(18,2)",
    ).select("*", F.lit("completed").alias("order_status"), F.lit("low").alias("order_value_segment"))
    dim = spark.createDataFrame([(1, "a"), (1, "a")], "customer_id long, customer_name string").withColumn(
        "customer_cohort_month", F.lit("2024-01-01").cast("timestamp_ntz")
    )
    row = retail.mart_sales_performance(fct, dim, NOW).first()
    assert (row.order_count, row.total_revenue) == (6, Decimal("30.02"))
    assert row.avg_order_value == Decimal("7.505000")
    assert (row.min_order_value, row.max_order_value) == (Decimal("5.01"), Decimal("10.00"))


def test_a_job_leaves_no_shuffle_files(spark, store):
    def shuffled():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
        return {b for b in blocks.split() if b.startswith("shuffle_")}

    @common.job
    def run(sources, store):
        store.overwrite("t", sources.groupBy((F.col("id") % 7).alias("k")).count(), ["k"], buckets=2)
        return common.Report()

    before = shuffled()
    run(spark.range(1000), store)
    until = time.monotonic() + 20  # files are removed in the background
    while shuffled() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffled() - before and store.read("t").count() == 7


def test_sap_runs_and_keeps_deleted_lines(spark, store, tmp_path):
    raw = gen_sap(spark, 11, date(2024, 3, 1), partners=5, orders_per=6)
    bronze = written(spark, {k: stamp_bronze(v, NOW) for k, v in raw.items()}, tmp_path / "b1")
    report = sap.run_sap(bronze, store, NOW)
    assert report.stages == ["silver", "silver gate", "gold", "gold gate", "publish", "finish"]
    assert not any(report.checks.values())
    n_lines = bronze["sap_sales_order_item"].count()
    fct = store.read("gold_sap/fct_sap_sales_lines")
    assert fct.count() == n_lines
    mart = store.read("gold_sap/mart_sap_chemical_sales_performance")
    open_value = fct.filter("order_status <> 'CANCELLED'").agg(F.sum("net_value")).first()[0]
    assert mart.agg(F.sum("total_net_value")).first()[0] == open_value
    assert report.published["fct_sap_sales_lines"]["published_rows"] == n_lines

    # lines of one order and the order itself disappear at the source
    gone = bronze["sap_sales_order"].orderBy("sales_order_number").first()["sales_order_number"]
    day = NOW + timedelta(days=1)
    second = written(
        spark,
        {
            **bronze,
            "sap_sales_order": bronze["sap_sales_order"].filter(F.col("sales_order_number") != gone),
            "sap_sales_order_item": bronze["sap_sales_order_item"].filter(F.col("sales_order_number") != gone),
        },
        tmp_path / "b2",
    )
    sap.run_sap(second, store, day)
    assert store.read("silver_sap/stg_sap_sales_order").filter(F.col("sales_order_number") == gone).count() == 0
    # lines are not pruned in Silver, nor is the fact
    assert store.read("silver_sap/stg_sap_sales_order_item").count() == n_lines
    assert store.read("gold_sap/fct_sap_sales_lines").count() == n_lines


SAP_LINE = (
    "sales_order_number string, partner_number string, order_date date, material_group string, product_hierarchy string, "
    "plant_code string, sales_organization string, country_code string, customer_group string, order_status string, "
    "deal_size_segment string, order_quantity_mt decimal(13,3), net_value decimal(15,2), unit_price_per_mt decimal(19,2)"
)


def test_sap_mart_drops_cancelled_and_unknown(spark):
    def line(order, partner, status, qty, value, price):
        return (order, partner, date(2024, 1, 9), "G", None, "P", "O", "TH", "C", status, "standard", qty, value, price)

    df = spark.createDataFrame(
        [
            line("1", "a", "COMPLETED", Decimal("2.000"), Decimal("10.00"), Decimal("5.00")),
            line("1", "a", "COMPLETED", Decimal("0.000"), Decimal("10.00"), None),
            line("2", "b", "COMPLETED", Decimal("1.000"), Decimal("2.00"), Decimal("2.00")),
            line("3", "c", "CANCELLED", Decimal("1.000"), Decimal("9.00"), Decimal("9.00")),
            line("4", "d", None, Decimal("1.000"), Decimal("9.00"), Decimal("9.00")),
        ],
        SAP_LINE,
    )
    got = sap.mart_sap_chemical_sales_performance(df, NOW).collect()
    assert len(got) == 1
    row = got[0]
    assert (row.line_count, row.order_count, row.customer_count) == (3, 2, 2)
    assert (row.total_quantity_mt, row.total_net_value) == (Decimal("3.000"), Decimal("22.00"))
    assert row.avg_unit_price_per_mt == Decimal("3.500000")
    assert row.order_month == date(2024, 1, 1)


def country(spark, *data):
    cols = f"countryid string, countrycode string, country string, importsequencenumber string, statecode string, statuscode string, {names.EXTRACTED_AT} timestamp_ntz"
    return spark.createDataFrame([(*r[:6], datetime.fromisoformat(r[6])) for r in data], cols)


def test_countries_dedupe(spark):
    raw = country(
        spark,
        ("g1 ", " th", "Thailand", "1", "0", "1", "2024-01-01"),
        ("g1 ", "th ", "Thailand newer", " ", "0", "1", "2024-01-02"),
        ("g2", "cf", "CAR", "2", "0", "1", "2024-01-05"),
        ("g3", "CF", "Central African Republic", "3", "1", "2", "2024-01-01"),
        ("g4", "xx", "named", "4", None, "2", "2024-01-01"),
        ("g5", "xx", None, "5", None, "1", "2024-01-01"),
        ("g6", None, "no code", "6", "0", None, "2024-01-01"),
        ("g7", None, "no code either", "7", "0", None, "2024-01-01"),
        (None, "zz", "no id", "8", "0", "1", "2024-01-01"),
    )
    silver = countries.stg_countries(raw, NOW)
    assert rows(silver, "country_id", "country_code", "import_sequence_number") == [
        ("g1", "TH", None),
        ("g3", "CF", 3),
        ("g5", "XX", 5),
        ("g7", None, 7),
    ]
    active = dict(rows(countries.dim_country(silver, NOW), "country_id", "is_active"))
    assert active == {"g1": True, "g3": False, "g5": None, "g7": None}


def test_countries_job(spark, store, tmp_path):
    raw = country(
        spark,
        ("g1", "TH", "Thailand", "1", "0", "1", "2024-01-01"),
        ("g2", "CF", "CAR", "2", "0", "1", "2024-01-05"),
        ("g3", "CF", "Central African Republic", "3", "0", "1", "2024-01-01"),
    )
    report = countries.run_countries(raw, store, NOW)
    assert report.stages == ["silver", "silver gate", "gold", "gold gate", "publish", "finish"]
    assert report.published["dim_country"] == {
        "warehouse_source": "gold_api.dim_country",
        "published_rows": 2,
        "publish_limit": None,
        "is_capped": False,
    }
    with pytest.raises(GateError):
        countries.run_countries(raw.union(raw.limit(1)), store, NOW)
    assert store.read("gold_api/dim_country").count() == 2
    specs = [PublishSpec("dim_country", ("country_id",), max_rows=1)]
    report = countries.run_countries(raw, store, NOW, publications=specs)
    assert report.published["dim_country"]["is_capped"]


def test_padded_partner_keys_survive_the_prune(spark):
    raw = spark.createDataFrame(
        [(" 100 ", "P", "th", "R", "I", "g", NOW, NOW)],
        "partner_number string, partner_name string, country_code string, region string, industry_sector string, "
        f"customer_group string, updated_at timestamp_ntz, {names.EXTRACTED_AT} timestamp_ntz",
    )
    first = sap.stg_sap_business_partner(raw, None, NOW)
    again = sap.stg_sap_business_partner(raw, first, NOW + timedelta(days=1))
    assert rows(again, "partner_number", names.BUILT_AT) == [("100", NOW + timedelta(days=1))]
