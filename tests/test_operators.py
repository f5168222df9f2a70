from __future__ import annotations

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import aggregates, dedupe, incremental, joins, prune, ranking
from strata.operators.conform import conform, exclude_value, is_empty, require_not_null
from strata.operators.contract import (
    check_load_contract,
    check_streams,
    ContractError,
    enforce_contract,
    load_mode_violations,
    load_modes,
    LoadSpec,
)
from strata.session import checkpoint_root
from tests.util import plan, rows, ts

CHANGES = "id long, name string, created_at timestamp_ntz, seen timestamp_ntz"


@pytest.fixture
def changes(spark):
    return spark.createDataFrame(
        [
            (1, "old", ts("2024-01-01"), ts("2024-01-01")),
            (1, "new", ts("2024-01-01"), ts("2024-01-03")),
            (1, "mid", ts("2024-01-01"), ts("2024-01-02")),
            (2, "never seen", ts("2024-01-01"), None),
            (2, "seen", ts("2024-01-01"), ts("2023-01-01")),
            (3, "tie a", ts("2024-01-01"), ts("2024-01-01")),
            (3, "tie b", ts("2024-01-01"), ts("2024-01-01")),
            (None, "no id", ts("2024-01-01"), ts("2024-01-01")),
            (None, "no id either", ts("2024-01-01"), ts("2024-01-02")),
        ],
        CHANGES,
    )


def test_latest_per_key(changes):
    got = rows(dedupe.latest_per_key(changes, ["id"], ["seen", "created_at"]), "id", "name")
    assert got == [(1, "new"), (2, "seen"), (3, "tie b"), (None, "no id either")]


def test_first_per_key_lets_null_win_when_asked(changes):
    got = rows(dedupe.first_per_key(changes, ["id"], [F.col("seen").desc_nulls_first()]), "id", "name")
    assert (2, "never seen") in got


def test_latest_per_key_limits_groups_before_the_shuffle(changes):
    text = plan(dedupe.latest_per_key(changes, ["id"], ["seen"]))
    physical = text[text.index("Physical Plan") :]
    assert physical.index("Final") < physical.index("Exchange") < physical.index("Partial")


def test_conform_casts_strictly(spark):
    df = spark.createDataFrame([("7", "x ")], "a string, b string")
    assert rows(conform(df, {"n": ("a", "bigint"), "t": F.trim("b")})) == [(7, "x")]
    with pytest.raises(PySparkException):
        conform(df, {"n": ("b", "bigint")}).collect()


def test_filters_treat_null_as_sql_does(spark):
    df = spark.createDataFrame([("CANCELLED",), ("OPEN",), (None,)], "s string")
    assert rows(exclude_value(df, "s", "CANCELLED")) == [("OPEN",)]
    assert rows(require_not_null(df, ["s"])) == [("CANCELLED",), ("OPEN",)]
    assert rows(incremental.delete_where(df, F.col("s") == "OPEN")) == [("CANCELLED",), (None,)]
    assert not is_empty(df)
    assert is_empty(df.filter("false"))


# ---- joins and prune


def test_orphans_count_null_keys(spark):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id long, k long")
    parent = spark.createDataFrame([(10,), (10,), (None,)], "p long")
    assert rows(joins.orphans(child, parent, {"k": "p"})) == [(2, 99), (3, None)]
    assert rows(joins.keep_keys(child, parent, {"k": "p"})) == [(1, 10)]


def test_null_keys_are_spread_and_hot_keys_split(spark):
    """Rows of one hot key and rows without a key must not meet in one task."""
    child = spark.range(60_000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 3 == 1, F.col("id")).cast("long").alias("k"),
    )
    parent = spark.range(30_000).select(F.col("id").alias("p"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        # several map outputs, since a skewed partition is cut between them
        gone = joins.drop_keys(child.repartition(16), parent, {"k": "p"})
        assert gone.count() == 20_000 + sum(1 for i in range(60_000) if i % 3 == 1 and i >= 30_000)
        counted = gone.groupBy().count()
        counted.collect()
        assert "skew=true" in plan(counted)
        nulls = gone.select("k", F.spark_partition_id().alias("p")).groupBy("p").agg(F.count_if(F.col("k").isNull()).alias("n"))
        assert max(r["n"] for r in nulls.collect()) < 20_000 / 2
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_key_side_is_reduced_before_the_shuffle(spark):
    text = plan(joins.keep_keys(spark.range(10), spark.range(10), "id"))
    assert "partial" in text.lower() or text.count("HashAggregate") >= 2


@pytest.fixture
def prune_frames(spark):
    target = spark.createDataFrame([("1",), (" 2 ",), ("3",), (None,)], "k string")
    source = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long")
    return target, source


def test_prune(prune_frames):
    target, source = prune_frames
    assert rows(prune.prune(target, source, "k", "id")) == [(" 2 ",), ("1",)]
    assert rows(prune.prune(target, source, "k", "id", raw_compare=True)) == [("1",)]
    assert rows(prune.absent_rows(target, source, "k", "id")) == [("3",), (None,)]


def test_prune_twice_changes_nothing(prune_frames):
    target, source = prune_frames
    once = prune.prune(target, source, "k", "id")
    assert rows(prune.prune(once, source, "k", "id")) == rows(once)


# ---- incremental


BATCH = "id long, v string, at timestamp_ntz"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", ts("2024-01-10")), (2, "b", ts("2024-01-08"))], BATCH)


@pytest.fixture
def source(spark):
    return spark.createDataFrame(
        [
            (1, "a2", ts("2024-01-07")),
            (2, "late", ts("2024-01-06 23:59:59")),
            (3, "new", ts("2024-01-11")),
            (3, "new twice", ts("2024-01-11")),
            (None, "no key", ts("2024-01-11")),
            (4, "no time", None),
        ],
        BATCH,
    )


def test_slice_bound_is_inclusive(source, target):
    got = rows(incremental.incremental_slice(source, target, "at"), "v")
    assert got == [("a2",), ("new",), ("new twice",), ("no key",)]


def test_slice_without_target_or_rows(source, target):
    assert incremental.incremental_slice(source, None, "at").count() == 6
    # an empty target is like none; so nothing is late
    assert incremental.incremental_slice(source, target.filter("false"), "at").count() == 6
    assert incremental.late_rows(source, target.filter("false"), ["id"], "at").count() == 0


def test_slice_bound_reaches_the_scan(spark, source, target, tmp_path):
    path = str(tmp_path / "src")
    source.write.parquet(path)
    text = plan(incremental.incremental_slice(spark.read.parquet(path), target, "at"))
    assert "GreaterThanOrEqual(at,2024-01-07" in text


def test_slice_keeps_microseconds(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 4, 0, 0, 0, 123456),), (datetime(2024, 1, 4),)], "at timestamp_ntz")
    tgt = spark.createDataFrame([(datetime(2024, 1, 7, 0, 0, 0, 123456),)], "at timestamp_ntz")
    assert rows(incremental.incremental_slice(df, tgt, "at")) == [(datetime(2024, 1, 4, 0, 0, 0, 123456),)]


def test_delete_insert(source, target):
    batch = incremental.incremental_slice(source, target, "at")
    once = incremental.delete_insert(target, batch, ["id"])
    assert rows(once, "id", "v") == [(1, "a2"), (2, "b"), (3, "new"), (3, "new twice"), (None, "no key")]
    keyed = batch.filter("id is not null")
    again = incremental.delete_insert(incremental.delete_insert(target, keyed, ["id"]), keyed, ["id"])
    assert rows(again) == rows(incremental.delete_insert(target, keyed, ["id"]))


def test_late_rows(source, target):
    assert rows(incremental.late_rows(source, target, ["id"], "at"), "id", "v") == [(2, "late"), (4, "no time")]


def test_evolution(spark):
    old = spark.createDataFrame([(1, "a", 1)], "id long, a string, n int")
    new = spark.createDataFrame([(2, "b", 2)], "id long, b string, n long")
    t, b = incremental.evolve(old, new, "append_new")
    assert t.columns == b.columns == ["id", "a", "n", "b"]
    assert rows(b) == [(2, None, 2, "b")]
    t, b = incremental.evolve(old, new, "sync_all")
    assert t.schema == b.schema
    assert t.columns == ["id", "b", "n"]
    assert t.schema["n"].dataType == T.LongType()
    assert incremental.evolve(old, new, "ignore")[1].columns == ["id", "a", "n"]
    with pytest.raises(ValueError):
        incremental.evolve(old, new, "whatever")


def test_upsert_and_insert_if_absent(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id long, v string, n int")
    new = spark.createDataFrame([(2, "B", 20), (3, "C", 30)], "id long, v string, n int")
    assert rows(incremental.upsert(old, new, ["id"])) == [(1, "a", 1), (2, "B", 20), (3, "C", 30)]
    assert rows(incremental.upsert(old, new, ["id"], ["v"])) == [(1, "a", 1), (2, "B", 2), (3, "C", 30)]
    partial = new.select("id", "v")
    assert rows(incremental.upsert(old, partial, ["id"], ["v"])) == [(1, "a", 1), (2, "B", 2), (3, "C", None)]
    assert rows(incremental.insert_if_absent(old, new.union(new), ["id"])) == [(1, "a", 1), (2, "b", 2), (3, "C", 30)]


def test_append_dedup_paths_agree(changes, spark):
    keyed = changes.filter("id is not null")
    first = incremental.append_dedup(None, keyed, ["id"], ["seen"])
    more = spark.createDataFrame(
        [(1, "older", ts("2024-01-01"), ts("2024-01-02")), (2, "newer", ts("2024-01-01"), ts("2024-02-01")), (9, "x", None, None)],
        CHANGES,
    )
    fast = incremental.append_dedup(first, more, ["id"], ["seen"], target_is_unique=True)
    slow = incremental.append_dedup(first, more, ["id"], ["seen"])
    assert rows(fast) == rows(slow)
    assert rows(fast, "id", "name") == [(1, "new"), (2, "newer"), (3, "tie b"), (9, "x")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 4), st.integers(0, 5)), max_size=12),
    st.lists(st.tuples(st.integers(0, 4), st.integers(0, 5)), max_size=12),
)
def test_delete_insert_against_brute_force(spark, old, new):
    schema = "id long, v long"
    t, b = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    keys = {k for k, _ in new}
    want = sorted([r for r in old if r[0] not in keys] + new, key=lambda r: [(False, str(v)) for v in r])
    assert rows(incremental.delete_insert(t, b, ["id"])) == want


# ---- aggregates and ranking


def test_sync_totals(spark):
    streams = spark.createDataFrame(
        [(1, 5, None), (1, 7, 2), (2, 1, 1), (3, None, None)], "job_id long, records_emitted long, records_committed long"
    )
    jobs = spark.createDataFrame(
        [(2, 100, None), (4, 9, 9), (3, None, None)], "job_id long, records_emitted long, records_committed long"
    )
    assert rows(aggregates.sync_totals(streams)) == [(1, 12, 2), (2, 1, 1), (3, 0, 0)]
    assert rows(aggregates.sync_totals(streams, jobs)) == [(1, 12, 2), (2, 100, None), (3, 0, 0), (4, 9, 9)]


def test_sums_and_distinct_agree_with_count_distinct(spark):
    rng = random.Random(9)
    data = [(rng.choice("ab") if i % 7 else None, rng.choice([None, "x", "y", "z"]), str(rng.randrange(40)), rng.choice([None, 1, 2])) for i in range(500)]
    df = spark.createDataFrame(data, "g string, p string, q string, n int")
    got = aggregates.sums_and_distinct(df, ["g"], {"rows": F.lit(1), "total": F.col("n")}, {"ps": "p", "qs": "q"})
    want = df.groupBy("g").agg(F.count("*"), F.sum("n"), F.countDistinct("p"), F.countDistinct("q"))
    assert rows(got) == rows(want)


def test_sums_and_distinct_shuffle_rows_once(spark):
    df = spark.range(10).selectExpr("id % 2 as g", "cast(id as string) as p", "cast(id % 3 as string) as q")
    got = aggregates.sums_and_distinct(df, ["g"], {"rows": F.lit(1)}, {"ps": "p", "qs": "q"})
    # by value, and the groups that are left
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2


def test_sums_and_distinct_of_a_stored_frame(spark, monkeypatch):
    rng = random.Random(10)
    data = [(rng.choice("aaaaab") if i % 9 else None, i % 50, rng.choice([None, "x", "y"]), str(rng.randrange(40)), rng.choice([None, 1, 2])) for i in range(600)]
    df = spark.createDataFrame(data, "g string, h int, p string, q string, n int")
    want = rows(df.groupBy("g", "h").agg(F.count("*"), F.sum("n"), F.countDistinct("p"), F.countDistinct("q")))
    for hot in (0, 5, 1000):  # all groups, some, none
        monkeypatch.setattr(aggregates, "HOT_ROWS", hot)
        assert rows(aggregates.sums_and_distinct(df, ["g", "h"], {"rows": F.lit(1), "total": F.col("n")}, {"ps": "p", "qs": "q"}, stored=True)) == want


def test_sums_and_distinct_shuffle_a_stored_frame_by_group_only(spark):
    df = spark.range(10).selectExpr("id % 2 as g", "cast(id as string) as p", "cast(id % 3 as string) as q")
    got = aggregates.sums_and_distinct(df, ["g"], {"rows": F.lit(1)}, {"ps": "p", "qs": "q"}, stored=True)
    exchanges = [line for line in plan(got).split("== Physical Plan ==")[1].splitlines() if "Exchange hashpartitioning" in line]
    # groups that are not hot; both ways count rows by hash (twice), and hot groups go by value and by group
    assert sorted("REPARTITION_BY_COL" in line for line in exchanges) == [False] * (len(exchanges) - 1) + [True]
    assert sum("tag#" in line for line in exchanges) == 1


def test_ordered_arrays_cut_a_hot_group(spark):
    df = spark.range(100).select(F.lit("g").alias("g"), ((F.col("id") * 37) % 100).alias("v"))
    got = aggregates.ordered_arrays(df, ["g"], "v", F.floor(F.col("v") / 10)).orderBy("chunk_id").collect()
    assert [v for r in got for v in r["sorted_values"]] == list(range(100))
    assert max(len(r["sorted_values"]) for r in got) == 10


def test_missing(spark):
    a = spark.createDataFrame([("x",), ("y",), ("y",)], "s string")
    assert rows(aggregates.missing(a, a.filter("s = 'x'"))) == [("y",)]


@pytest.mark.parametrize("sample_rows", [50, 2000, 100_000])
def test_first_rows_is_exact(spark, monkeypatch, sample_rows):
    monkeypatch.setattr(ranking, "SAMPLE_ROWS", sample_rows)
    rng = random.Random(3)
    data = [(rng.choice([None, "a", "b", "c"]), date(2024, 1, 1 + rng.randrange(28)), i) for i in range(5000)]
    df = spark.createDataFrame(data, "s string, d date, n long").repartition(8)
    got = [tuple(r) for r in ranking.first_rows(df, ["s", "d", "n"], 100, 10).collect()]
    want = sorted(data, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))[:100]
    assert got == want


def test_first_rows_of_a_table_below_the_cap(spark):
    assert ranking.first_rows(spark.range(1000), ["id"], 1_000_000_000).count() == 1000
    assert ranking.first_rows(spark.range(1000), ["id"], 0).count() == 0


def test_first_rows_cut_limits_the_sorted_rows(spark):
    df = spark.range(100_000)
    out = ranking.first_rows(df, ["id"], 100, 10)
    assert "<=" in plan(out)
    assert [r[0] for r in out.collect()] == list(range(100))


@pytest.mark.parametrize("n", [0, 1, 99, 100, 5000, 19_999, 20_000, 20_001])
def test_first_rows_come_in_key_order_at_any_size(spark, n):
    df = spark.range(20_000).select((F.lit(19_999) - F.col("id")).alias("id")).repartition(5)
    assert [r[0] for r in ranking.first_rows(df, ["id"], n, 100).collect()] == list(range(min(n, 20_000)))


def test_first_rows_among_equal_rows(spark):
    df = spark.range(5000).select(F.lit(1).alias("k")).union(spark.range(50).select(F.lit(0).alias("k")))
    assert [r[0] for r in ranking.first_rows(df, ["k"], 300, 10).collect()] == [0] * 50 + [1] * 250


# ---- contracts


CONTRACT = T.StructType([T.StructField("id", T.LongType()), T.StructField("amount", T.DecimalType(18, 2))])


def test_enforce_contract(spark):
    good = spark.createDataFrame([(Decimal("1.00"), 1)], "amount decimal(18,2), id long")
    assert enforce_contract(good, CONTRACT).columns == ["id", "amount"]
    with pytest.raises(ContractError, match="amount is double"):
        enforce_contract(good.withColumn("amount", F.col("amount").cast("double")), CONTRACT)
    with pytest.raises(ContractError, match="missing column amount"):
        enforce_contract(good.drop("amount"), CONTRACT)
    with pytest.raises(ContractError, match="outside the contract"):
        enforce_contract(good.withColumn("extra", F.lit(1)), CONTRACT)
    assert enforce_contract(good.withColumn("extra", F.lit(1)), CONTRACT, allow_extra=True).columns[-1] == "extra"


def test_load_contract(spark):
    spec = LoadSpec("s", ["id"], "at", columns=["id", "v"])
    good = spark.createDataFrame([(1, "a", ts("2024-01-02"))], BATCH)
    assert check_load_contract(good, spec, "2024-01-01").count() == 0
    bad = spark.createDataFrame([(1, "a", ts("2024-01-02")), (1, "b", None), (None, "c", None)], BATCH).drop("v")
    got = rows(check_load_contract(bad, spec, "2024-02-01"), "rule", "failing_rows")
    assert got == [
        ("column v present", 1),
        ("cursor not null", 2),
        ("high water not going back", 1),
        ("key id not null", 1),
        ("key unique", 1),
    ]
    assert check_streams([spec, LoadSpec("t", ["id"])], {"s": good}) == ["t"]


def test_load_modes_against_the_declared_ones(spark):
    declared = [LoadSpec("a", ["id"], "at"), LoadSpec("b", ["x", "y"]), LoadSpec("c", ["id"]), LoadSpec("same", ["k"])]
    configured = [
        LoadSpec("a", ["id"], "seen", sync_mode="full_refresh", destination_mode="overwrite"),
        LoadSpec("b", ["y", "x"]),
        LoadSpec("d", ["id"]),
        LoadSpec("same", ["k"]),
    ]
    got = rows(load_mode_violations(load_modes(spark, declared), load_modes(spark, configured)))
    assert got == [
        ("a", "cursor", "at", "seen"),
        ("a", "destination_mode", "append_dedup", "overwrite"),
        ("a", "sync_mode", "incremental", "full_refresh"),
        ("c", "stream", "c", None),
        ("d", "stream", None, "d"),
    ]


def test_partial_upsert_with_null_keys(spark):
    target = spark.createDataFrame([(1, "a", 1), (None, "b", 2)], "k long, v string, n long")
    batch = spark.createDataFrame([(None, "B"), (2, "c")], "k long, v string")
    assert rows(incremental.upsert(target, batch, ["k"], ["v"])) == [(1, "a", 1), (2, "c", None), (None, "B", 2)]


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
    assert checkpoint_root(spark) == checkpoint_root(spark)


def test_columns_named_like_helpers_survive(spark):
    df = spark.createDataFrame([(1, 1, "a", 7), (1, 2, "b", 8), (None, 3, "c", 9)], "id long, at long, _rank string, _spread long")
    df = df.withColumns({"_key_0": F.lit(5), "_key_spread": F.lit(6), "_parent": F.lit(4)})
    latest = dedupe.latest_per_key(df, ["id"], ["at"])
    assert latest.columns == df.columns and rows(latest, "at", "_rank") == [(2, "b"), (3, "c")]
    keys = spark.createDataFrame([(1,)], "id long")
    kept = joins.keep_keys(df, keys, "id")
    assert kept.columns == df.columns and rows(kept, "_spread", "_key_0") == [(7, 5), (8, 5)]
    assert rows(joins.drop_keys(df, keys, "id"), "_spread") == [(9,)]


def test_lines_are_not_shuffled_for_partners(spark):
    """The partner's columns join the headers; joined to the lines they moved every line once more."""
    items = spark.createDataFrame([("i", "o", "m")], "line_mark string, sales_order_number string, material_number string")
    orders = spark.createDataFrame([("o", "p")], "sales_order_number string, partner_number string")
    materials, partners = spark.createDataFrame([("m", 1)], "material_number string, weight int"), spark.createDataFrame([("p", 2)], "partner_number string, size int")
    got = joins.enrich_lines(items, orders, materials, partners)
    assert [r.asDict() for r in got.collect()] == [{"line_mark": "i", "sales_order_number": "o", "material_number": "m", "partner_number": "p", "weight": 1, "size": 2}]
    lines = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depths = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    at = next(i for i, line in enumerate(lines) if "Join Inner, (partner_number" in line)
    end = next((i for i in range(at + 1, len(lines)) if depths[i] <= depths[at]), len(lines))
    assert end > at + 1 and not any("line_mark" in line for line in lines[at + 1 : end])
