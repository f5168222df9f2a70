from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from strata.operators import quality
from strata.operators.incremental import delete_where, upsert
from strata.operators.quality import Check, GateError, checks_for, gate, run_checks
from strata.sources.generate import drill_duplicate_email, drill_orphan_order, gen_customer_orders, gen_customers, is_drill_row
from strata.sources.landing import WATERMARK_SCHEMA
from strata.sources.store import store_failures
from tests.util import rows


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(1, "a@x", 5.0), (2, "a@x", -1.0), (3, None, None), (3, None, 0.0), (None, "b@x", 10.0)],
        "id long, email string, balance double",
    )


def test_single_checks(spark, people):
    assert rows(quality.not_null(people, "email"), "id") == [(3,), (3,)]
    assert rows(quality.unique(people, "email")) == [("a@x", 2)]
    assert rows(quality.unique(people, "id")) == [(3, 2)]
    assert rows(quality.accepted_range(people, "balance", 0), "id") == [(2,)]
    assert rows(quality.accepted_range(people, "balance", 0, 10, inclusive=False), "id") == [(2,), (3,), (None,)]
    parents = spark.createDataFrame([(1,), (None,)], "p long")
    assert rows(quality.relationships(people, "id", parents, "p")) == [(2, 1), (3, 2)]


def test_suite_agrees_with_single_checks(spark, people):
    parents = spark.createDataFrame([(1,)], "p long")
    checks = [
        *checks_for(
            "people",
            people,
            not_null=["id", "email"],
            unique=["id", "email"],
            relationships={"id": (parents, "p")},
            ranges={"balance": (0, None)},
        ),
        Check("rule_people", "rule", people.filter("balance > 100")),
    ]
    got = dict(rows(run_checks(checks)))
    assert got == {
        "not_null_people_id": 1,
        "not_null_people_email": 2,
        "unique_people_id": 1,
        "unique_people_email": 1,
        "relationships_people_id": 3,
        "accepted_range_people_balance": 1,
        "rule_people": 0,
    }
    with pytest.raises(GateError) as error:
        gate(run_checks(checks))
    assert "rule_people" not in error.value.failed
    assert gate(run_checks([checks[-1]])) == {"rule_people": 0}


def test_row_checks_share_one_scan(spark, people, tmp_path):
    path = str(tmp_path / "people")
    people.write.parquet(path)
    stored = spark.read.parquet(path)
    text = run_checks(checks_for("p", stored, not_null=["id", "email"], ranges={"balance": (0, 9)}))
    physical = text._jdf.queryExecution().executedPlan().toString()
    assert physical.count("FileScan") == 1


def test_quarantine_and_preview(people):
    bad = quality.not_null(people, "email")
    good, out = quality.quarantine(people, bad, "id")
    assert rows(good, "id") == [(1,), (2,), (None,)]
    assert rows(out, "id") == [(3,), (3,)]
    assert quality.preview(people, ["balance"], 2).count() == 2


def test_freshness_limits(spark, run_ts):
    ages = {"fresh": 35, "edge": 36, "late": 37, "edge_error": 48, "stale": 49}
    log = spark.createDataFrame(
        [(s, "c", None, run_ts - timedelta(hours=h), 1, 0, 0) for s, h in ages.items()], WATERMARK_SCHEMA
    )
    got = dict(rows(quality.freshness(log, [*ages, "missing"], run_ts), "bronze_schema", "status"))
    assert got == {
        "fresh": "pass",
        "edge": "pass",
        "late": "warn",
        "edge_error": "warn",
        "stale": "error",
        "missing": "error",
    }


def test_drill_fires_and_reverts(spark, run_ts):
    customers = gen_customers(spark, 5, run_ts)
    orders = gen_customer_orders(customers, 3, 1, run_ts)
    broken_customers = upsert(
        customers.withColumn("id", F.col("id").cast("bigint")),
        drill_duplicate_email(spark, "customer.1@example.com", run_ts),
        ["id"],
    )
    stray = drill_orphan_order(spark, run_ts)
    broken_orders = upsert(orders.withColumn("customer_id", F.col("customer_id").cast("bigint")), stray, ["id"])
    checks = [
        *checks_for("customers", broken_customers, unique=["email"]),
        *checks_for("orders", broken_orders, relationships={"customer_id": (customers, "id")}),
    ]
    with pytest.raises(GateError) as error:
        gate(run_checks(checks))
    assert error.value.failed == {"unique_customers_email": 1, "relationships_orders_customer_id": 1}
    again = upsert(broken_orders, stray, ["id"])
    assert again.count() == orders.count() + 1
    assert delete_where(broken_orders, is_drill_row("id", "status")).count() == orders.count()


def test_store_failures(store, people, run_ts):
    kept = store_failures(store, quality.not_null(people, "email"), "not_null_people_email", run_ts)
    assert kept.count() == 2
    assert kept.select("checked_at").distinct().first()[0] == datetime(2024, 3, 1)
    assert store_failures(store, people, "other", run_ts, enabled=False) is None
    assert not store.exists("audit/other")
