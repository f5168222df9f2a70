"""Load modes, merges and sinks, written to a store of their own and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import columns as names
from strata.operators import quality
from strata.plans import bronze, retail
from strata.plans.bronze import Tables
from strata.plans.registry import base
from strata.plans.registry.base import CUT, RUN_TS, TS, query
from strata.plans.registry.incremental import MID, NEWEST_EVENT
from strata.plans.registry.jobs import fresh_store
from strata.sources import landing, publish
from strata.sources.publish import PublishSpec
from strata.sources.readers import read_json_records
from strata.sources.store import build_view, store_failures

EVENT_KEYS = ["user_id", "event_type"]


@query("load_overwrite", "SELECT * FROM customer")
def load_overwrite(t: Tables) -> DataFrame:
    store = fresh_store(t)
    landing.load_overwrite(store, "customer", t.customer.withColumn("c_acctbal", F.lit(0.0)))
    return landing.load_overwrite(store, "customer", t.customer)


# the second delivery overlaps the first
@query(
    "load_append_dedup",
    f"SELECT * EXCLUDE (rn) FROM (SELECT *, {NEWEST_EVENT} AS rn FROM events) WHERE rn = 1",
)
def load_append_dedup(t: Tables) -> DataFrame:
    store, split = fresh_store(t), F.lit(MID).cast("timestamp_ntz")
    landing.load_append_dedup(store, "events", t.events.filter(F.col("ts") < split), EVENT_KEYS, ["ts"], buckets=16)
    again = t.events.filter(F.col("ts") >= split - F.expr("INTERVAL 2 DAYS"))
    return landing.load_append_dedup(store, "events", again, EVENT_KEYS, ["ts"], buckets=16)


# errors come without a user; loading them again and again changes nothing
NO_USER = "CASE WHEN event_type = 'error' THEN NULL ELSE user_id END"


@query(
    "append_dedup_null_keys",
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC,
  event_id DESC) AS rn FROM (SELECT event_id, ts, {NO_USER} AS user_id, event_type, value FROM events)) WHERE rn = 1""",
)
def append_dedup_null_keys(t: Tables) -> DataFrame:
    store = fresh_store(t)
    events = t.events.select("event_id", "ts", F.expr(NO_USER).alias("user_id"), "event_type", "value")
    for _ in range(2):
        stored = landing.load_append_dedup(store, "events", events, EVENT_KEYS, ["ts", "event_id"], buckets=16)
    return stored


@query(
    "snapshot_copy",
    f"""SELECT *, {TS} AS _airbyte_extracted_at, '{{}}' AS _airbyte_meta, 1 AS n_ids FROM orders""",
)
def snapshot_copy(t: Tables) -> DataFrame:
    copies = landing.snapshot_copy(fresh_store(t), {"nation": t.nation, "orders": t.orders}, "src", RUN_TS)
    return copies["orders"].withColumn("n_ids", (F.length(names.RAW_ID) == 32).cast("int")).drop(names.RAW_ID)


@query("snapshot_copy_nation", f"SELECT *, {TS} AS _airbyte_extracted_at, '{{}}' AS _airbyte_meta FROM nation")
def snapshot_copy_nation(t: Tables) -> DataFrame:
    """The other table of a copy of several."""
    copies = landing.snapshot_copy(fresh_store(t), {"nation": t.nation, "orders": t.orders}, "src", RUN_TS)
    return copies["nation"].drop(names.RAW_ID)


# orders by month: late ones are replaced, those of customers in debt are pruned
@query(
    "stored_merge",
    f"""SELECT o_orderkey, o_custkey, o_orderdate, CASE WHEN o_orderdate >= TIMESTAMP '{CUT}' OR o_orderstatus = 'F'
  THEN o_totalprice ELSE 0 END AS o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey AND c_acctbal >= 0""",
)
def stored_merge(t: Tables) -> DataFrame:
    store = fresh_store(t)
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    month, recent = F.date_format("o_orderdate", "yyyy-MM"), F.col("o_orderdate") >= F.lit(CUT).cast("timestamp_ntz")
    before = orders.filter(~recent).withColumn("o_totalprice", F.lit(0.0))
    store.merge("orders", before, ["o_orderkey"], month)
    finished = t.orders.filter(recent | (F.col("o_orderstatus") == "F")).select(*orders.columns)
    solvent = t.customer.filter("c_acctbal >= 0").select("c_custkey")
    alive = t.orders.join(solvent, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey")
    return store.merge("orders", finished, ["o_orderkey"], month, alive=(alive, "o_orderkey"))


@query(
    "stored_snapshot",
    f"""WITH {base.STG_CUSTOMERS}
SELECT customer_id, customer_name, email, created_at, _airbyte_extracted_at,
  _airbyte_extracted_at AS dbt_updated_at, _airbyte_extracted_at AS dbt_valid_from,
  CASE WHEN c_acctbal < 0 THEN {TS} END AS dbt_valid_to
FROM stg_customers JOIN customer ON customer_id = c_custkey""",
)
def stored_snapshot(t: Tables) -> DataFrame:
    store = fresh_store(t)
    now = retail.stg_customers_batch(bronze.customers(t), None, RUN_TS)
    retail.store_snapshot(store, "history", now, RUN_TS)
    solvent = t.customer.filter("c_acctbal >= 0").select(F.col("c_custkey").alias("customer_id"))
    history = retail.store_snapshot(store, "history", now.join(solvent, "customer_id", "left_semi"), RUN_TS)
    return history.drop(names.SCD_ID)


@query(
    "store_failures",
    f"SELECT *, {TS} AS checked_at FROM customer WHERE c_acctbal < 0",
)
def stored_failures(t: Tables) -> DataFrame:
    broken = quality.accepted_range(t.customer, "c_acctbal", 0)
    return store_failures(fresh_store(t), broken, "accepted_range_customer_c_acctbal", RUN_TS)


# the first publication holds other prices; of the second, rows of the same key replace them
@query(
    "publish",
    """SELECT p_partkey, p_name, CASE WHEN p_size < 25 THEN p_retailprice ELSE 0 END AS p_retailprice FROM part""",
)
def published(t: Tables) -> DataFrame:
    store, spec = fresh_store(t), PublishSpec("part", ("p_partkey",))
    parts = t.part.select("p_partkey", "p_name", F.col("p_retailprice").cast("decimal(18,2)").alias("p_retailprice"))
    publish.publish(store, parts.withColumn("p_retailprice", F.lit(0).cast("decimal(18,2)")), spec)
    small = t.part.filter("p_size < 25").select(*[F.col(c).cast(parts.schema[c].dataType) for c in parts.columns])
    return publish.publish(store, small, spec)[0]


# no cap unless one is given; each line once, however often it is published
@query(
    "publish_all_rows",
    """SELECT l_orderkey, l_linenumber, CAST(max(l_quantity) AS DOUBLE) AS l_quantity FROM lineitem GROUP BY 1, 2""",
)
def publish_all_rows(t: Tables) -> DataFrame:
    lines = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").cast("double").alias("l_quantity"))
    return publish.publish(fresh_store(t), lines, PublishSpec("lines", ("l_orderkey", "l_linenumber")))[0]


# the mart of a table whose key has NULLs, published twice, the second time with one more column
@query(
    "publish_null_keys",
    f"""SELECT {NO_USER} AS user_id, event_type, count(*) AS n_events, CAST(max(value) AS DOUBLE) AS most
FROM events GROUP BY 1, 2""",
)
def publish_null_keys(t: Tables) -> DataFrame:
    mart = t.events.groupBy(F.expr(NO_USER).alias("user_id"), "event_type").agg(
        F.count("*").alias("n_events"), F.max("value").cast("double").alias("most")
    )
    store, spec = fresh_store(t), PublishSpec("mart", ("user_id", "event_type"))
    publish.publish(store, mart.drop("most"), spec)
    return publish.publish(store, mart, spec)[0]


@query(
    "export_csv",
    """SELECT c_custkey, c_name, c_acctbal, strftime(last_order, '%Y-%m-%dT%H:%M:%S') AS last_order
FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
)
def exported(t: Tables) -> DataFrame:
    last = t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_order"))
    rows = t.customer.join(last, F.col("c_custkey") == F.col("o_custkey"), "left")
    path = f"{fresh_store(t).root}/csv"
    publish.export_csv(rows.select("c_custkey", "c_name", "c_acctbal", "last_order"), path)
    schema = "c_custkey bigint, c_name string, c_acctbal double, last_order string"
    return t.spark.read.schema(schema).option("header", True).csv(path)


# API responses landed as files, one per line, their records under "result"
@query("json_files", "SELECT event_id, user_id, event_type FROM events")
def json_files(t: Tables) -> DataFrame:
    path = f"{fresh_store(t).root}/api"
    record = F.struct("event_id", "user_id", "event_type")
    t.events.select(F.to_json(F.struct(F.array(record).alias("result")))).write.text(path)
    schema = T.StructType([t.events.schema[c] for c in ("event_id", "user_id", "event_type")])
    return read_json_records(t.spark, path, "result", schema, whole_files=False)


@query(
    "view_query",
    f"""WITH {base.INT_ORDERS} SELECT order_value_segment, count(*) AS n_orders FROM int_orders GROUP BY 1""",
)
def view_query(t: Tables) -> DataFrame:
    silver = retail.stg_orders_batch(bronze.orders(t), None, RUN_TS)
    build_view(retail.int_orders_enriched(silver, base.SEGMENTS), "int_orders_enriched")
    return t.spark.sql("SELECT order_value_segment, count(*) AS n_orders FROM int_orders_enriched GROUP BY 1")
