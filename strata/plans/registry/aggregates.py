"""Aggregates, joins, set operations and sorted results over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import aggregates, calendar, joins
from strata.operators.ranking import first_rows
from strata.plans.bronze import Tables
from strata.plans.registry.base import query


@query("key_bounds", "SELECT min(o_orderdate) AS min_value, max(o_orderdate) AS max_value FROM orders")
def key_bounds(t: Tables) -> DataFrame:
    return calendar.bounds(t.orders, "o_orderdate")


@query(
    "date_spine",
    """WITH b AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events)
SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM b""",
)
def date_spine(t: Tables) -> DataFrame:
    return calendar.date_spine(t.events, "ts", "day")


@query(
    "count_distinct",
    """SELECT l_returnflag, count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_orders,
  count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY 1""",
)
def count_distinct(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("l_orderkey").alias("n_orders"),
        F.countDistinct("l_partkey").alias("n_parts"),
    )


@query(
    "duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicate_keys(t: Tables) -> DataFrame:
    return aggregates.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "ordered_arrays",
    """SELECT p_brand, CAST(p_partkey // 1000 AS BIGINT) AS chunk_id,
  string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY p_partkey) AS part_keys FROM part GROUP BY 1, 2""",
)
def ordered_arrays(t: Tables) -> DataFrame:
    arrays = aggregates.ordered_arrays(t.part, ["p_brand"], "p_partkey", F.floor(F.col("p_partkey") / 1000))
    return arrays.select("p_brand", "chunk_id", F.array_join("sorted_values", ",").alias("part_keys"))


# streams are event types and jobs are users; jobs whose errors were counted report their own totals
@query(
    "sync_totals",
    """WITH s AS (SELECT user_id, event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS e,
  CASE WHEN event_type <> 'view' THEN count(*) END AS c FROM events GROUP BY 1, 2),
o AS (SELECT user_id, count(*) AS e, NULL AS c FROM events WHERE event_type = 'error' GROUP BY 1 HAVING count(*) > 5)
SELECT s.user_id AS job_id,
  CASE WHEN any_value(o.e) IS NOT NULL THEN any_value(o.e) ELSE CAST(sum(s.e) AS BIGINT) END AS records_emitted,
  CASE WHEN any_value(o.e) IS NULL THEN CAST(sum(coalesce(s.c, 0)) AS BIGINT) END AS records_committed
FROM s LEFT JOIN o ON s.user_id = o.user_id GROUP BY 1""",
)
def sync_totals(t: Tables) -> DataFrame:
    emitted = F.get_json_object("props", "$.k").cast("bigint")
    streams = t.events.groupBy(F.col("user_id").alias("job_id"), "event_type").agg(
        F.sum(emitted).alias("records_emitted"),
        F.when(F.col("event_type") != "view", F.count(F.lit(1))).alias("records_committed"),
    )
    own = (
        t.events.filter("event_type = 'error'")
        .groupBy(F.col("user_id").alias("job_id"))
        .agg(F.count(F.lit(1)).alias("records_emitted"))
        .filter("records_emitted > 5")
        .withColumn("records_committed", F.lit(None).cast("bigint"))
    )
    return aggregates.sync_totals(streams, own)


@query(
    "reconcile_counts",
    """SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer
UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'events', count(*) FROM events
UNION ALL SELECT 'order_lines', count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""",
)
def reconcile_counts(t: Tables) -> DataFrame:
    return aggregates.reconcile(
        {
            "customer": t.customer,
            "orders": t.orders,
            "lineitem": t.lineitem,
            "events": t.events,
            "order_lines": t.lineitem.select("l_orderkey", "l_linenumber").distinct(),
        }
    )


# streams seen ever against streams seen since the 25th
@query(
    "missing_streams",
    """SELECT user_id, event_type FROM events
EXCEPT SELECT user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-25'""",
)
def missing_streams(t: Tables) -> DataFrame:
    late = t.events.filter(F.col("ts") >= F.lit("2024-01-25").cast("timestamp_ntz"))
    return aggregates.missing(t.events.select("user_id", "event_type"), late.select("user_id", "event_type"))


@query(
    "union_all",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""",
)
def union_all(t: Tables) -> DataFrame:
    return aggregates.union_all(
        t.customer.selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance"),
        t.supplier.selectExpr("s_acctbal AS balance", "s_name AS name", "s_suppkey AS id"),
    )


@query(
    "series_join",
    "SELECT c_custkey, CAST(n AS INTEGER) AS n FROM customer, (SELECT unnest(generate_series(1, 5)) AS n)",
)
def series_join(t: Tables) -> DataFrame:
    return joins.series_join(t.customer.select("c_custkey"), 1, 5)


@query("sorted_customers", "SELECT c_custkey, c_name, c_nationkey FROM customer ORDER BY c_name")
def sorted_customers(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_name", "c_nationkey").orderBy("c_name")


@query(
    "first_rows",
    "SELECT * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice LIMIT 1000",
)
def first_lines(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    return first_rows(t.lineitem, keys, 1000)
