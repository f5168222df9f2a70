from __future__ import annotations

import random
from datetime import datetime, timedelta

from strata import columns as names
from strata.operators.history import scd2_apply, scd2_build, scd2_start
from tests.util import plan, rows, ts

STATE = "id long, city string, seen timestamp_ntz"
VERSION = ["id", "city", names.SCD_VALID_FROM, names.SCD_VALID_TO]


def state(spark, *data):
    return spark.createDataFrame([(i, c, ts(s)) for i, c, s in data], STATE)


def test_unchanged_newer_older_deleted_and_new(spark, run_ts):
    first = state(
        spark,
        (1, "same", "2024-01-01"),
        (2, "before", "2024-01-01"),
        (3, "kept", "2024-01-05"),
        (4, "gone", "2024-01-01"),
    )
    second = state(
        spark, (1, "same", "2024-01-01"), (2, "after", "2024-01-03"), (3, "stale", "2024-01-04"), (5, "new", "2024-01-02")
    )
    history = scd2_apply(None, first, "id", "seen", run_ts)
    after = scd2_apply(history, second, "id", "seen", run_ts)
    assert rows(after, *VERSION) == sorted(
        [
            (1, "same", ts("2024-01-01"), None),
            (2, "before", ts("2024-01-01"), ts("2024-01-03")),
            (2, "after", ts("2024-01-03"), None),
            (3, "kept", ts("2024-01-05"), None),
            (4, "gone", ts("2024-01-01"), run_ts),
            (5, "new", ts("2024-01-02"), None),
        ],
        key=lambda r: [(v is None, str(v)) for v in r],
    )
    again = scd2_apply(after, second, "id", "seen", datetime(2024, 4, 1))
    assert rows(again, *VERSION) == rows(after, *VERSION)


def test_deleted_key_comes_back(spark, run_ts):
    history = scd2_start(state(spark, (1, "a", "2024-01-01")), "id", "seen")
    gone = scd2_apply(history, state(spark), "id", "seen", run_ts)
    back = scd2_apply(gone, state(spark, (1, "b", "2024-02-01")), "id", "seen", datetime(2024, 4, 1))
    assert rows(back, *VERSION) == [
        (1, "a", ts("2024-01-01"), run_ts),
        (1, "b", ts("2024-02-01"), None),
    ]


def test_without_hard_deletes_versions_stay_open(spark, run_ts):
    history = scd2_start(state(spark, (1, "a", "2024-01-01")), "id", "seen")
    after = scd2_apply(history, state(spark), "id", "seen", run_ts, hard_deletes=False)
    assert rows(after, *VERSION) == [(1, "a", ts("2024-01-01"), None)]


def test_build_matches_brute_force_with_a_hot_key(spark):
    rng = random.Random(5)
    base = datetime(2024, 1, 1)
    data = {(k, base + timedelta(hours=rng.randrange(2000))) for k in [1] * 300 + list(range(2, 60))}
    df = spark.createDataFrame([(k, "x", t) for k, t in data], STATE)
    want = []
    for key in {k for k, _ in data}:
        times = sorted(t for k, t in data if k == key)
        want += [(key, "x", a, b) for a, b in zip(times, [*times[1:], None], strict=True)]
    got = rows(scd2_build(df.union(df), "id", "seen", chunk_rows=3), *VERSION)
    assert got == sorted(want, key=lambda r: [(v is None, str(v)) for v in r])


def test_stored_snapshot_rewrites_open_versions_only(spark, store, run_ts):
    from strata.plans.retail import SNAPSHOT_COLUMNS, snap_stg_customers, store_snapshot

    def customers(*data):
        return spark.createDataFrame(
            [(i, n, f"{n}@x", ts("2024-01-01"), ts(s)) for i, n, s in data],
            "customer_id long, customer_name string, email string, created_at timestamp_ntz, "
            f"{names.EXTRACTED_AT} timestamp_ntz",
        ).select(*SNAPSHOT_COLUMNS)

    states = [
        customers((1, "a", "2024-01-01"), (2, "b", "2024-01-01")),
        customers((1, "a2", "2024-01-02"), (2, "b", "2024-01-01"), (3, "c", "2024-01-02")),
        customers((1, "a3", "2024-01-03"), (3, "c", "2024-01-02")),
        customers((1, "a3", "2024-01-03"), (2, "b2", "2024-01-04"), (3, "c", "2024-01-02")),
    ]
    want = None
    for i, current in enumerate(states):
        now = run_ts + timedelta(days=i)
        want = snap_stg_customers(want, current, now)
        got = store_snapshot(store, "snap", current, now)
        assert rows(got, *want.columns) == rows(want)
    closed = [p for p in store.partitions("snap") if p != "open"]
    assert len(closed) == 2
    assert store.read("snap", parts=["open"]).count() == 3


def test_null_keys_do_not_grow(spark):
    day = [ts(f"2024-01-0{i}") for i in range(1, 5)]
    schema = "id long, seen timestamp_ntz"
    first = spark.createDataFrame([(1, day[0]), (None, day[0])], schema)
    history = None
    for current in (first, first, first):
        history = scd2_apply(history, current, "id", "seen", day[3])
    assert history.count() == 2
    changed = spark.createDataFrame([(1, day[0]), (None, day[1])], schema)
    history = scd2_apply(history, changed, "id", "seen", day[3])
    assert rows(history, "id", "seen", names.SCD_VALID_TO) == [(1, day[0], None), (None, day[0], day[1]), (None, day[1], None)]


def test_a_hot_key_of_one_day_is_cut(spark):
    """One key with a third of the rows, all of one day, and the same in one chunk and in many."""
    hot = spark.range(3000).selectExpr("1L as id", "timestampadd(SECOND, id, timestamp_ntz '2024-01-01') as seen")
    cold = spark.range(6000).selectExpr("10 + id % 600 as id", "timestampadd(DAY, id, timestamp_ntz '2024-01-01') as seen")
    df = hot.union(cold)
    few, many = (scd2_build(df, "id", "seen", chunk_rows=n) for n in (10_000, 200))
    assert rows(few, "id", "seen", names.SCD_VALID_TO) == rows(many, "id", "seen", names.SCD_VALID_TO)
    text = plan(many)
    assert "percentile_approx" in text and "_chunk" in text
