"""As-of lookups, reconciliation by row, responses of any shape, widened types, bucketed tables, syncs and marts kept up."""

from __future__ import annotations

import json
import random
from contextlib import contextmanager
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import columns as names
from strata.operators import asof, checksums, incremental
from strata.plans import common, marts, retail
from strata.plans.bronze import Tables
from strata.plans.registry import lookups
from strata.sources.landing import Sync, sync_table
from strata.sources.readers import split_responses
from strata.sources.store import TableStore
from tests.test_jobs import NOW, retail_bronze, written
from tests.test_sources import files, touched
from tests.util import plan, rows, ts

FOLDER = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **conf):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# ---- as of


def test_as_of_by_brute_force(spark):
    rng, start = random.Random(1), datetime(1960, 1, 1)
    versions, facts = [], []
    for key in (*range(6), None):
        at = start
        for v in range(rng.randrange(0, 30)):
            until = at + timedelta(seconds=rng.choice([1, 3600, 10**5, 10**7, 10**9]))
            versions.append((key, at, None if rng.random() < 0.05 else until, f"{key}-{v}"))
            at = until + timedelta(seconds=rng.choice([0, 0, 50]))
    bounds = [b for _, a, b, _ in versions for b in (a, b) if b]
    for n in range(800):
        facts.append((n, rng.choice([*range(7), None]), rng.choice([None, rng.choice(bounds), rng.choice(bounds) - timedelta(seconds=1), datetime(2500, 1, 1)])))
    want = sorted((n, v) for n, k, at in facts for key, a, b, v in versions if k is not None and k == key and at and a <= at and (b is None or at < b))
    history = spark.createDataFrame(versions, "k long, since timestamp_ntz, until timestamp_ntz, v string")
    df = spark.createDataFrame(facts, "n long, k long, at timestamp_ntz")
    found = asof.as_of(df.withColumn("_bin", F.lit(1)), history, "k", "at", "since", "until")
    assert found.columns == ["n", "k", "at", "_bin", "v"] and sorted(rows(found, "n", "v")) == want
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(found)
        assert "SortMergeJoin" in text and "NestedLoop" not in text and "Cartesian" not in text
    assert asof.as_of(df, history.limit(0), "k", "at", "since", "until").count() == 0


# ---- reconciliation


def test_differing_rows_are_found_and_equal_ranges_not_read(spark, monkeypatch):
    base = spark.range(200_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"), F.lit(None).cast("string").alias("w"))
    changed, gone = {5, 77_777, 199_999}, {100, 150_001}
    edited = base.filter(~F.col("k").isin(gone)).withColumn("v", F.when(F.col("k").isin(changed), -1).otherwise(F.col("v")))
    edited = edited.union(spark.createDataFrame([(-300, 1, "x"), (900_000, 2, None)], base.schema))
    want = sorted([(k, "changed") for k in changed] + [(k, "missing") for k in gone] + [(-300, "extra"), (900_000, "extra")])
    assert sorted(map(tuple, checksums.differing_rows(base, edited, "k").collect())) == want
    ranges = checksums.differing_ranges(base, edited, "k", ["v", "w"])
    assert sum(r.high - r.low for r in ranges) < 2_000  # of a million
    levels = []
    count = checksums.range_checksums
    monkeypatch.setattr(checksums, "range_checksums", lambda df, key, columns, parents: levels.append(sum(r.high - r.low for r in parents)) or count(df, key, columns, parents))
    checksums.differing_rows(base, edited, "k")
    assert levels == sorted(levels, reverse=True) and levels[-1] < levels[0] / 50
    levels.clear()
    assert checksums.differing_rows(base, base.repartition(3), "k").count() == 0
    assert len(levels) == 2  # one level for either side, and no rows


def test_differences_all_over(spark):
    base = spark.range(50_000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    edited = base.filter("k % 90 <> 7").withColumn("v", F.when(F.col("k") % 80 == 3, 2).otherwise(F.col("v")))
    got = checksums.differing_rows(base, edited, "k").groupBy("difference").count()
    n_missing = sum(k % 90 == 7 for k in range(50_000))
    assert dict(rows(got)) == {"missing": n_missing, "changed": sum(k % 80 == 3 and k % 90 != 7 for k in range(50_000))}


def test_differing_rows_with_null_and_repeated_keys(spark):
    a = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "x"), (None, "y")], "k long, v string")
    b = spark.createDataFrame([(1, "a"), (2, None), (None, "y"), (None, "x")], "k long, v string")
    assert rows(checksums.differing_rows(a, b, "k")) == [(1, "changed"), (2, "changed")]
    assert rows(checksums.differing_rows(a, b.filter("k is not null"), "k")) == [(1, "changed"), (2, "changed"), (None, "missing")]
    assert checksums.differing_rows(a.limit(0), b.limit(0), "k").count() == 0
    assert checksums.differing_rows(a.limit(0), b, "k").filter("difference = 'extra'").count() == 3


def test_the_differing_ranges_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10_000).select(F.col("id").alias("k"), F.lit(1).alias("v")).write.parquet(path)
    a = spark.read.parquet(path)
    text = plan(checksums.differing_rows(a, a.withColumn("v", F.when(F.col("k") == 5000, 2).otherwise(F.col("v"))), "k"))
    assert "GreaterThanOrEqual(k,4" in text or "GreaterThanOrEqual(k,5000" in text


# ---- responses


def test_split_responses(spark):
    bodies = [
        (1, json.dumps([{"id": 1, "name": "a"}, {"id": "2", "name": None}])),
        (2, json.dumps({"page": 1, "value": [{"id": 3, "name": "c", "new": {"x": [1]}}]})),
        (3, json.dumps({"id": 4, "name": "one object"})),
        (4, '{"data": ['),
        (5, None),
        (6, " \n"),
        (7, "null"),
        (8, json.dumps({"result": [{"id": "x"}, [1], {"name": "no id"}, {"id": None}, {"id": 1.5}]})),
        (9, "[]"),
        (10, '"text"'),
    ]
    df = spark.createDataFrame([(p, b, "kept") for p, b in bodies], "page long, body string, _record string")
    good, bad = split_responses(df, "body", {"id": "bigint", "name": "string"}, ["id"])
    assert good.columns == ["page", "_record", "id", "name", "extra"]
    assert sorted(rows(good, "page", "id", "name", "extra"), key=str) == [
        (1, 1, "a", None), (1, 2, None, None), (2, 3, "c", '{"new":{"x":[1]}}'), (3, 4, "one object", None),
    ]
    reasons = sorted(rows(bad, "page", "reason"))
    assert [r for r in reasons if r[0] != 8] == [(4, "malformed"), (5, "empty"), (6, "empty"), (7, "no records"), (10, "no records")]
    assert [r for _, r in reasons if _ == 8].count("missing id") == 2 and reasons.count((8, "not an object")) == 1 and reasons.count((8, "bad id")) == 2


def test_split_responses_parses_a_body_once(spark):
    """The filters on reasons went below the projections and parsed a body again for each time that they named it."""
    df = spark.range(3).select("id", F.concat(F.lit('{"id": '), "id", F.lit("}")).alias("body"))
    good, bad = split_responses(df, "body", {"id": "bigint"})
    physical = [plan(df).split("== Physical Plan ==")[1] for df in (good, bad)]
    assert [text.count("parseJson") for text in physical] == [1, 2]  # the quarantine: bodies, and records


# ---- types


@pytest.mark.parametrize(
    ("a", "b", "common"),
    [
        ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("int", "decimal(5,2)", "decimal(12,2)"),
        ("decimal(10,4)", "decimal(12,2)", "decimal(14,4)"), ("bigint", "double", "double"), ("date", "timestamp_ntz", "timestamp_ntz"),
        ("date", "timestamp", "timestamp"), ("string", "int", "string"), ("boolean", "int", "string"), ("array<int>", "array<bigint>", "array<bigint>"),
        ("decimal(38,0)", "decimal(10,5)", "string"), ("struct<x:int>", "struct<x:bigint>", "struct<x:bigint>"),
    ],
)
def test_common_type(a, b, common):
    x, y = (T._parse_datatype_string(t) if "<" in t else T._parse_datatype_string(f"c {t}")["c"].dataType for t in (a, b))
    assert incremental.common_type(x, y).simpleString() == incremental.common_type(y, x).simpleString() == common


def test_no_common_type():
    with pytest.raises(TypeError):
        incremental.common_type(T.ArrayType(T.LongType()), T.LongType())


def test_evolve_widens_and_narrows_on_request(spark):
    wide = spark.createDataFrame([(1, 10_000_000_000), (2, 5)], "id long, n long")
    slim = spark.createDataFrame([(3, 7)], "id long, n int")
    for mode in ("append_new", "sync_all"):
        for target, batch in ((wide, slim), (slim, wide)):
            old, new = incremental.evolve(target, batch, mode)
            assert old.schema["n"].dataType == new.schema["n"].dataType == T.LongType()
            assert {r["n"] for r in old.union(new).collect()} == {5, 7, 10_000_000_000}
    old, _ = incremental.evolve(wide, slim, "sync_all", {"n": T.IntegerType()})
    assert rows(old) == [(1, None), (2, 5)]
    assert rows(incremental.not_fitting(wide, {"n": T.IntegerType()}), "id") == [(1,)]


# ---- bucketed tables


def test_bucketed_joins_exchange_nothing_by_their_key(spark):
    t = Tables(spark, FOLDER)
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        star = plan(lookups.bucketed_star(t).groupBy("order_id").count())
        assert "SortMergeJoin" in star and "hashpartitioning(customer_id" not in star
        orphans = plan(lookups.bucketed_orphans(t))
        assert "LeftAnti" in orphans and "Exchange" not in orphans.split("== Physical Plan ==")[1]


# ---- syncs


def test_sync_reads_from_the_cursor_on_and_counts(spark, store, tmp_path):
    path, day = str(tmp_path / "src"), datetime(2024, 1, 1)
    schema = "id long, at timestamp_ntz, v string"

    def sync(*data):
        spark.createDataFrame([(i, ts(a), v) for i, a, v in data], schema).write.mode("overwrite").parquet(path)
        return sync_table(store, "t", spark.read.parquet(path), Sync(("id",), "at", 4), day, ["v"])

    first = sync((1, "2024-01-01", "a"), (1, "2024-01-02", "a2"), (2, "2024-01-03", None), (3, None, "no cursor"))
    assert (first.emitted, first.committed, first.nulls) == (4, 3, {"v": 1})
    # 4 shares the largest cursor value; 5 is older than it and is not read
    second = sync((2, "2024-01-03", None), (4, "2024-01-03", "d"), (5, "2024-01-01", "late"), (1, "2024-01-04", "a3"))
    assert (second.emitted, second.committed, second.nulls) == (3, 3, {"v": 1})
    assert rows(second.table, "id", "v") == [(1, "a3"), (2, None), (3, "no cursor"), (4, "d")]
    with pytest.raises(ValueError, match="needs a key"):
        sync_table(store, "u", second.table, Sync((), "at"), day)


def test_sync_shuffles_and_stages_no_row_twice(spark, store, monkeypatch):
    staged, stage, day = [], TableStore.stage, datetime(2024, 1, 1)
    monkeypatch.setattr(TableStore, "stage", lambda self, name, df: (staged.append(name), stage(self, name, df))[1])
    source = spark.range(40).select("id", F.lit(ts("2024-01-01")).alias("at"), F.lit("a").alias("v"))
    sync_table(store, "t", source, Sync(("id",), "at", 4), day)
    assert staged == ["t/arriving"]
    later = source.filter("id < 30").withColumn("at", F.lit(ts("2024-01-02"))).withColumn("v", F.lit("b"))
    found = sync_table(store, "t", later, Sync(("id",), "at", 4), day)
    assert staged == ["t/arriving", "t/arriving", "t/fresh"] and (found.emitted, found.committed) == (30, 30)
    assert rows(found.table.groupBy("v").count()) == [("a", 10), ("b", 30)]
    assert sync_table(store, "t", later.filter("false"), Sync(("id",), "at", 4), day).table.count() == 40
    # another column, or number of buckets, rewrites the table
    newest = later.withColumn("at", F.lit(ts("2024-01-03"))).withColumn("w", F.col("id"))
    wider = sync_table(store, "t", newest, Sync(("id",), "at", 4), day).table
    assert rows(wider.groupBy("v", F.col("w").isNull()).count()) == [("a", True, 10), ("b", False, 30)]
    assert sync_table(store, "t", newest, Sync(("id",), "at", 2), day).table.count() == 40
    assert store.partitions("t") == ["0-of-2", "1-of-2"]


# ---- late rows


def test_late_changes_look_at_the_change_feed_only(spark, store):
    def fact(*data):
        return spark.createDataFrame([(i, ts(a), s, ts(x)) for i, a, s, x in data], f"order_id long, order_date timestamp_ntz, s string, {names.LAST_EXTRACTED_AT} timestamp_ntz")

    month = marts.month_of("order_date")
    stored = [(1, "2024-01-05", "a", "2024-03-01"), (2, "2024-01-06", "b", "2024-03-01"), (3, "2024-02-05", "c", "2024-03-01"), (4, "2024-03-01", "d", "2024-03-01")]
    store.merge("f", fact(*stored), ["order_id"], month)
    now = fact(
        (1, "2024-01-05", "A", "2024-03-02"),  # late and changed
        (2, "2024-01-06", "b", "2024-03-02"),  # late, the same
        (3, "2024-02-05", "C", "2024-02-01"),  # changed, but extracted long ago
        (4, "2024-03-01", "D", "2024-03-02"),  # within the slice
        (9, "2024-01-09", "n", "2024-03-02"),  # late and new
        (8, None, "x", "2024-03-02"),  # without a date
    ).withColumnRenamed(names.LAST_EXTRACTED_AT, names.EXTRACTED_AT)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    with settings(spark, **conf):
        late = common.late_changes(store, "f", now, ["order_id"], "order_date", month, 3)
        text = plan(late)
        assert "might_contain" in text and "dynamicpruning" in text
        assert rows(late, "order_id") == [(1,), (8,), (9,)]


def test_late_changes_open_few_months(spark, store, monkeypatch):
    opened, read = [], TableStore.read_parts
    df = spark.range(100).select(
        F.col("id").alias("order_id"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(int(id))").alias("order_date"), F.lit("a").alias("s"), F.lit(ts("2024-05-01")).cast("timestamp_ntz").alias(names.LAST_EXTRACTED_AT)
    )
    month = marts.month_of("order_date")
    store.merge("f", df, ["order_id"], month)
    changed = df.withColumnRenamed(names.LAST_EXTRACTED_AT, names.EXTRACTED_AT).withColumn(names.EXTRACTED_AT, F.when(F.col("order_id") == 40, F.lit(ts("2024-05-02")).cast("timestamp_ntz")).otherwise(F.lit(ts("2023-01-01")).cast("timestamp_ntz")))
    monkeypatch.setattr(TableStore, "read_parts", lambda self, table, parts: (opened.extend(r[0] for r in parts.distinct().collect()), read(self, table, parts))[1])
    late = common.late_changes(store, "f", changed.withColumn("s", F.lit("b")), ["order_id"], "order_date", month, 3)
    assert rows(late, "order_id") == [(40,)] and opened == ["2024-02"]


# ---- marts


def test_a_run_reads_and_rewrites_only_the_months_that_changed(spark, store, tmp_path, monkeypatch):
    bronze = written(spark, retail_bronze(spark, 6, 100), tmp_path / "b1")  # a hundred days back
    retail.run_retail(bronze, store, NOW, publications=[])
    mart, state = retail.MART, retail.MART_STATE
    months = store.partitions(mart)
    assert len(months) >= 3 and store.partitions(state) == months
    before, summed = files(store, mart), files(store, state)
    opened, read = [], TableStore.read_parts
    monkeypatch.setattr(TableStore, "read_parts", lambda self, table, parts: (opened.append((table, sorted(r[0] for r in parts.distinct().collect()))), read(self, table, parts))[1])

    day = NOW + timedelta(days=1)
    stamp = F.lit(str(day)).cast("timestamp_ntz")
    orders = bronze["orders"]
    newest = orders.agg(F.max("order_date")).first()[0]
    recent = F.col("order_date") == F.lit(str(newest)).cast("timestamp_ntz")
    changed = orders.withColumn("status", F.when(recent, "cancelled").otherwise(F.col("status"))).withColumn(names.EXTRACTED_AT, F.when(recent, stamp).otherwise(F.col(names.EXTRACTED_AT)))
    second = written(spark, {"customers": bronze["customers"], "orders": changed}, tmp_path / "b2")
    retail.run_retail(second, store, day, publications=[])
    last = sorted({f"{newest - timedelta(days=d):%Y-%m}" for d in range(4)})  # the slice looks back three days
    assert touched(store, mart, before) == touched(store, state, summed) == last
    assert {p for table, parts in opened if table.startswith("gold_sales/fct_orders") for p in parts} == set(last)

    def rebuilt():
        fresh = retail.mart_sales_performance(store.read("gold_sales/fct_orders"), store.read("gold_sales/dim_customer"), day)
        return rows(fresh.drop(names.BUILT_AT))

    assert rows(store.read(mart).drop(names.BUILT_AT)) == rebuilt()

    # a customer gets another name: the months with their orders are put together again, without the fact
    opened.clear()
    renamed = bronze["customers"].withColumn("name", F.when(F.col("id") == 1, F.lit("New Name")).otherwise(F.col("name"))).withColumn(names.EXTRACTED_AT, stamp)
    third = written(spark, {"customers": renamed, "orders": changed}, tmp_path / "b3")
    retail.run_retail(third, store, day + timedelta(hours=1), publications=[])
    assert store.read(mart).filter("customer_id = 1 and customer_name <> 'New Name'").count() == 0
    assert rows(store.read(mart).drop(names.BUILT_AT)) == rebuilt()
    assert {p for table, parts in opened if table == "gold_sales/fct_orders" for p in parts} <= set(last)

    # a run that fails before the mart leaves its months to the next one
    def fails(*_, **__):
        raise RuntimeError("lost")

    gone = written(spark, {"customers": renamed.filter("id <> 2"), "orders": changed.filter("customer_id <> 2")}, tmp_path / "b4")
    with monkeypatch.context() as m:
        m.setattr(retail, "refresh_mart", fails)
        with pytest.raises(RuntimeError, match="lost"):
            retail.run_retail(gone, store, day + timedelta(hours=2), publications=[])
    retail.run_retail(gone, store, day + timedelta(hours=3), publications=[])
    assert store.read(mart).filter("customer_id = 2").count() == 0
    assert rows(store.read(mart).drop(names.BUILT_AT)) == rebuilt()
