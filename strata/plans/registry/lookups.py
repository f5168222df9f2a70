"""As-of lookups, reconciliation by row, responses of any shape, widened types and bucketed tables over the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import columns as names
from strata.operators import asof, checksums, history, joins, quality
from strata.operators.incremental import not_fitting
from strata.plans import bronze, retail
from strata.plans.bronze import Tables
from strata.plans.registry import base
from strata.plans.registry.base import RUN_TS, query
from strata.plans.registry.jobs import fresh_store
from strata.plans.registry.models import dim_date, enriched_orders, silver_customers
from strata.sources.landing import Sync, sync_table
from strata.sources.readers import split_responses
from strata.sources.store import bucket_table


# each line with the priority that its customer's latest order had when the line was shipped
@query(
    "asof_versions",
    """WITH v AS (SELECT o_custkey, o_orderdate, max(o_orderpriority) AS priority FROM orders GROUP BY 1, 2),
h AS (SELECT *, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS until FROM v)
SELECT l_orderkey, l_linenumber, l_shipdate, l.o_custkey, priority
FROM (SELECT l_orderkey, l_linenumber, l_shipdate, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey) l
JOIN h ON l.o_custkey = h.o_custkey AND l_shipdate >= h.o_orderdate AND (until IS NULL OR l_shipdate < until)""",
)
def asof_versions(t: Tables) -> DataFrame:
    changes = t.orders.groupBy("o_custkey", "o_orderdate").agg(F.max("o_orderpriority").alias("priority"))
    versions = history.scd2_build(changes, "o_custkey", "o_orderdate")
    owners = t.orders.select("o_orderkey", "o_custkey")
    lines = t.lineitem.join(owners, F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "l_shipdate", "o_custkey")
    return asof.as_of(lines, versions, "o_custkey", "l_shipdate", names.SCD_VALID_FROM, names.SCD_VALID_TO, ["priority"])


# the copy lacks some orders, holds some changed and some that the source doesn't have
@query(
    "reconcile_rows",
    """SELECT o_orderkey, 'missing' AS difference FROM orders WHERE o_orderkey % 97 = 0
UNION ALL SELECT o_orderkey, 'changed' FROM orders WHERE o_orderkey % 97 <> 0 AND o_orderkey % 101 = 5
UNION ALL SELECT -1 - o_orderkey, 'extra' FROM orders WHERE o_orderkey % 103 = 7""",
)
def reconcile_rows(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    edited = t.orders.filter(key % 97 != 0).withColumn("o_totalprice", F.when(key % 101 == 5, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")))
    copy = edited.union(t.orders.filter(key % 103 == 7).withColumn("o_orderkey", -1 - key))
    return checksums.differing_rows(t.orders, copy, "o_orderkey")


# what landed against the model built from it, row by row: Silver lacks the orders that have no customer
@query(
    "reconcile_layers",
    "SELECT o_orderkey AS order_id, 'missing' AS difference FROM orders WHERE o_orderkey % 50 = 3",
)
def reconcile_layers(t: Tables) -> DataFrame:
    raw = bronze.orders(t).withColumn("customer_id", F.when(F.col("id") % 50 != 3, F.col("customer_id")))
    silver = retail.stg_orders_batch(raw, None, RUN_TS)
    landed = raw.select(F.col("id").alias("order_id"), F.col("amount").alias("order_amount"), "order_date")
    return checksums.differing_rows(landed, silver.select(landed.columns), "order_id")


def responses(t: Tables) -> DataFrame:
    """An API response per event: whole ones, one without a wrapper, broken and empty ones, and ones whose fields drifted."""
    user, kind = F.col("user_id").cast("string"), F.col("event_type")
    plain = F.concat(F.lit('{"user_id": "'), user, F.lit('", "event_type": "'), kind, F.lit('"}'))
    n = F.col("event_id") % 9
    body = (
        F.when(n == 0, F.concat(F.lit("["), plain, F.lit(", "), plain, F.lit("]")))
        .when(n == 1, F.concat(F.lit('{"next": 1, "data": ['), plain, F.lit("]}")))
        .when(n == 2, plain)
        .when(n == 3, F.concat(F.lit('{"data": ['), plain))
        .when(n == 4, "  ")
        .when(n == 5, F.concat(F.lit('{"result": [{"user_id": "u'), user, F.lit('", "event_type": "'), kind, F.lit('"}, '), plain, F.lit("]}")))
        .when(n == 6, F.concat(F.lit('{"value": [{"user_id": '), user, F.lit(', "event_type": "'), kind, F.lit('", "plan": "new"}]}')))
        .when(n == 7, F.concat(F.lit('{"data": [7, {"event_type": "'), kind, F.lit('"}, '), plain, F.lit("]}")))
        .otherwise("42")
    )
    return t.events.select("event_id", body.alias("body"))


FIELDS = {"user_id": "bigint", "event_type": "string"}


@query(
    "responses_records",
    """SELECT event_id, user_id, event_type, CASE WHEN event_id % 9 = 6 THEN '{"plan":"new"}' END AS extra
FROM (SELECT *, unnest(range(CASE event_id % 9 WHEN 0 THEN 2 WHEN 3 THEN 0 WHEN 4 THEN 0 WHEN 8 THEN 0 ELSE 1 END)) FROM events)""",
)
def responses_records(t: Tables) -> DataFrame:
    return split_responses(responses(t), "body", FIELDS, ["user_id"])[0]


@query(
    "responses_quarantine",
    """SELECT event_id, CASE event_id % 9 WHEN 3 THEN 'malformed' WHEN 4 THEN 'empty' WHEN 8 THEN 'no records' WHEN 5 THEN 'bad user_id'
  ELSE 'not an object' END AS reason, CASE event_id % 9 WHEN 4 THEN '  ' WHEN 8 THEN '42' WHEN 7 THEN '7'
  WHEN 3 THEN '{"data": [{"user_id": "' || user_id || '", "event_type": "' || event_type || '"}'
  ELSE '{"event_type":"' || event_type || '","user_id":"u' || user_id || '"}' END AS content
FROM events WHERE event_id % 9 IN (3, 4, 5, 7, 8)
UNION ALL SELECT event_id, 'missing user_id', '{"event_type":"' || event_type || '"}' FROM events WHERE event_id % 9 = 7""",
)
def responses_quarantine(t: Tables) -> DataFrame:
    return split_responses(responses(t), "body", FIELDS, ["user_id"])[1]


# an integer column stored as bigint and arriving as int, and the other way round; a whole number meets a fraction
@query(
    "evolve_widening",
    """SELECT o_orderkey + CASE WHEN o_orderkey % 2 = 0 THEN 10000000000 ELSE 0 END AS id, o_custkey + CASE WHEN o_orderkey % 2 = 1 THEN
  10000000000 ELSE 0 END AS customer, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice ELSE floor(o_totalprice) END AS price FROM orders""",
)
def evolve_widening(t: Tables) -> DataFrame:
    even, big = F.col("o_orderkey") % 2 == 0, F.lit(10_000_000_000)
    price, whole = F.col("o_totalprice").cast("decimal(15,2)"), F.floor("o_totalprice").cast("int")
    stored = t.orders.filter(even).select((F.col("o_orderkey") + big).alias("id"), F.col("o_custkey").cast("int").alias("customer"), price.alias("price"))
    arriving = t.orders.filter(~even).select(F.col("o_orderkey").cast("int").alias("id"), (F.col("o_custkey") + big).alias("customer"), whole.alias("price"))
    store = fresh_store(t)
    store.overwrite("t", stored, ["id"])
    return store.merge("t", arriving, ["id"], on_schema_change="sync_all")


SMALL = T.ShortType()


@query(
    "evolve_not_fitting",
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice <> round(l_extendedprice) OR l_extendedprice > 32767""",
)
def evolve_not_fitting(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(15,2)").alias("l_extendedprice"))
    return not_fitting(lines, {"l_extendedprice": SMALL})


def bucketed(t: Tables, df: DataFrame, key: str, buckets: int = 8) -> DataFrame:
    """The frame as a bucketed catalog table of its own name in the query's folder."""
    name = f"bucketed_{uuid.uuid4().hex}"
    return bucket_table(df, name, [key], buckets, f"{fresh_store(t).root}/{name}")


def bucketed_star(t: Tables) -> DataFrame:
    fct = bucketed(t, retail.fct_orders(enriched_orders(t), None, RUN_TS).drop(names.BUILT_AT), "customer_id")
    dim = bucketed(t, retail.dim_customer(silver_customers(t), None, RUN_TS).drop(names.BUILT_AT), "customer_id")
    return joins.star_query(fct, dim, dim_date(t).drop(names.BUILT_AT))


@query(
    "star_bucketed",
    f"""WITH {base.DIM_CUSTOMER}, {base.INT_ORDERS}
SELECT order_id, customer_name, monthname(order_date_key) AS month_name, CAST(order_amount AS DOUBLE) AS order_amount
FROM int_orders JOIN dim_customer USING (customer_id)""",
)
def star_bucketed(t: Tables) -> DataFrame:
    return bucketed_star(t).select("order_id", "customer_name", "month_name", "order_amount")


def bucketed_orphans(t: Tables) -> DataFrame:
    orders = bucketed(t, t.orders.select("o_orderkey", "o_custkey"), "o_custkey")
    solvent = bucketed(t, t.customer.filter("c_acctbal >= 0").select("c_custkey"), "c_custkey")
    return quality.relationships(orders, "o_custkey", solvent, "c_custkey")


@query(
    "fk_bucketed",
    """SELECT o_custkey, count(*) AS n_rows FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY 1""",
)
def fk_bucketed(t: Tables) -> DataFrame:
    return bucketed_orphans(t)


# orders as they come in, read by their cursor; each sync reads the day again that the last one ended with
STEPS = ["1996-06-01", "1999-01-01", "2030-01-01"]


def syncs(t: Tables) -> tuple[DataFrame, list[tuple]]:
    store, done = fresh_store(t), []
    for step in STEPS:
        seen = t.orders.filter(F.col("o_orderdate") <= F.lit(step).cast("timestamp_ntz"))
        found = sync_table(store, "orders", seen, Sync(("o_orderkey",), "o_orderdate"), RUN_TS, ["o_custkey"])
        done.append((step, found.emitted, found.committed, found.nulls["o_custkey"]))
    return found.table, done


@query("sync_by_cursor", "SELECT * FROM orders")
def sync_by_cursor(t: Tables) -> DataFrame:
    return syncs(t)[0].drop(names.RAW_ID, names.EXTRACTED_AT, names.META)


@query(
    "sync_counts",
    " UNION ALL ".join(
        f"""SELECT '{step}' AS step, count(*) AS emitted, count(*) AS committed, CAST(0 AS BIGINT) AS nulls FROM orders
WHERE o_orderdate <= TIMESTAMP '{step}'"""
        + (f" AND o_orderdate >= (SELECT max(o_orderdate) FROM orders WHERE o_orderdate <= TIMESTAMP '{before}')" if before else "")
        for before, step in zip([None, *STEPS], STEPS, strict=False)
    ),
)
def sync_counts(t: Tables) -> DataFrame:
    """What each sync read and kept, counted while it was written."""
    return t.spark.createDataFrame(syncs(t)[1], "step string, emitted long, committed long, nulls long")
