"""Slices, table changes by key, schema evolution, pruning and history over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import columns as names
from strata.operators import dedupe, history, incremental, prune
from strata.plans.bronze import Tables
from strata.plans.registry.base import CUT, RUN_TS, TS, query

MID = "2024-01-15"


def orders(t: Tables) -> DataFrame:
    return t.orders.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))


ORDERS = "o AS (SELECT * REPLACE (CAST(o_totalprice AS DOUBLE) AS o_totalprice) FROM orders)"


@query("read_incremental", f"SELECT * FROM events WHERE ts >= TIMESTAMP '{MID}'")
def read_incremental(t: Tables) -> DataFrame:
    return incremental.read_incremental(t.events, "ts", MID)


@query("high_water", "SELECT max(l_shipdate) AS high_water FROM lineitem")
def high_water(t: Tables) -> DataFrame:
    return incremental.high_water(t.lineitem, "l_shipdate")


@query(
    "incremental_slice",
    f"""SELECT * FROM events WHERE ts >= (SELECT max(ts) - INTERVAL 3 DAYS FROM events WHERE ts < TIMESTAMP '{MID}')""",
)
def incremental_slice(t: Tables) -> DataFrame:
    return incremental.incremental_slice(t.events, t.events.filter(F.col("ts") < F.lit(MID).cast("timestamp_ntz")), "ts")


# the slice on a DATE column: ship days against order days
@query(
    "incremental_slice_dates",
    """SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_day FROM lineitem
WHERE CAST(l_shipdate AS DATE) >= (SELECT max(CAST(o_orderdate AS DATE)) - 3 FROM orders)""",
)
def incremental_slice_dates(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("ship_day"))
    days = t.orders.select(F.col("o_orderdate").cast("date").alias("order_day"))
    return incremental.incremental_slice(lines, days, "ship_day", "order_day")


# stored: orders before the cut, with finished ones still open; the batch is what the slice picks up
@query(
    "delete_insert",
    f"""WITH {ORDERS}, b AS (SELECT max(o_orderdate) - INTERVAL 3 DAYS AS b FROM o WHERE o_orderdate < TIMESTAMP '{CUT}')
SELECT o.* REPLACE (CASE WHEN o_orderdate >= b THEN o_orderstatus ELSE 'O' END AS o_orderstatus) FROM o, b""",
)
def delete_insert(t: Tables) -> DataFrame:
    now = orders(t)
    stored = now.filter(F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz")).withColumn("o_orderstatus", F.lit("O"))
    batch = incremental.incremental_slice(now, stored, "o_orderdate")
    return incremental.delete_insert(stored, batch, ["o_orderkey"])


# lines repeat their key: all rows of a batch key replace all stored rows of that key
@query(
    "delete_insert_duplicate_keys",
    f"""WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '{CUT}')
SELECT l_orderkey, l_linenumber, -l_quantity AS l_quantity FROM lineitem l WHERE NOT EXISTS
  (SELECT 1 FROM b WHERE b.l_orderkey = l.l_orderkey AND b.l_linenumber = l.l_linenumber)
UNION ALL SELECT * FROM b""",
)
def delete_insert_duplicate_keys(t: Tables) -> DataFrame:
    cols = ["l_orderkey", "l_linenumber", "l_quantity"]
    stored = t.lineitem.select(*cols).withColumn("l_quantity", -F.col("l_quantity"))
    batch = t.lineitem.filter(F.col("l_shipdate") >= F.lit(CUT).cast("timestamp_ntz")).select(*cols)
    return incremental.delete_insert(stored, batch, ["l_orderkey", "l_linenumber"])


@query(
    "late_rows",
    f"""WITH b AS (SELECT max(o_orderdate) - INTERVAL 3 DAYS AS b FROM orders WHERE o_orderdate < TIMESTAMP '{CUT}')
SELECT orders.* FROM orders, b WHERE o_orderdate < b AND o_orderstatus <> 'O'""",
)
def late_rows(t: Tables) -> DataFrame:
    now = t.orders
    stored = now.filter(F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz")).withColumn("o_orderstatus", F.lit("O"))
    return incremental.late_rows(now, stored, ["o_orderkey"], "o_orderdate")


NEWEST_EVENT = """row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST,
  value DESC NULLS LAST, props DESC NULLS LAST)"""


@query(
    "latest_per_key",
    f"SELECT * EXCLUDE (rn) FROM (SELECT *, {NEWEST_EVENT} AS rn FROM events) WHERE rn = 1",
)
def latest_per_key(t: Tables) -> DataFrame:
    return dedupe.latest_per_key(t.events, ["user_id", "event_type"], ["ts"])


@query(
    "append_dedup",
    f"SELECT * EXCLUDE (rn) FROM (SELECT *, {NEWEST_EVENT} AS rn FROM events) WHERE rn = 1",
)
def append_dedup(t: Tables) -> DataFrame:
    split = F.lit(MID).cast("timestamp_ntz")
    keys, cursor = ["user_id", "event_type"], ["ts"]
    stored = incremental.append_dedup(None, t.events.filter(F.col("ts") < split), keys, cursor)
    # the second delivery overlaps the first
    again = t.events.filter(F.col("ts") >= split - F.expr("INTERVAL 2 DAYS"))
    return incremental.append_dedup(stored, again, keys, cursor, target_is_unique=True)


@query(
    "insert_if_absent",
    f"""WITH f AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
  ORDER BY event_id DESC) AS rn FROM events WHERE event_type <> 'click' OR ts >= TIMESTAMP '{MID}') WHERE rn = 1),
s AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
  ORDER BY ts, event_id) AS rn FROM events WHERE ts < TIMESTAMP '{MID}') WHERE rn = 1)
SELECT * FROM s UNION ALL
SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.user_id = f.user_id AND s.event_type = f.event_type)""",
)
def insert_if_absent(t: Tables) -> DataFrame:
    keys = ["user_id", "event_type"]
    early = F.col("ts") < F.lit(MID).cast("timestamp_ntz")
    stored = dedupe.first_per_key(t.events.filter(early), keys, [F.col("ts").asc(), F.col("event_id").asc()])
    return incremental.insert_if_absent(stored, t.events.filter((F.col("event_type") != "click") | ~early), keys)


@query(
    "upsert",
    f"""WITH s AS (SELECT o_custkey, max(o_orderdate) AS last_order, count(*) AS n_orders FROM orders
  WHERE o_orderdate < TIMESTAMP '{CUT}' GROUP BY 1),
b AS (SELECT o_custkey, max(o_orderdate) AS last_order, count(*) AS n_orders FROM orders
  WHERE o_orderdate >= TIMESTAMP '{CUT}' GROUP BY 1)
SELECT * FROM s WHERE o_custkey NOT IN (SELECT o_custkey FROM b) UNION ALL SELECT * FROM b""",
)
def upsert(t: Tables) -> DataFrame:
    old, new = _order_counts(t)
    return incremental.upsert(old, new, ["o_custkey"])


@query(
    "upsert_some_columns",
    f"""WITH s AS (SELECT o_custkey, max(o_orderdate) AS last_order, count(*) AS n_orders FROM orders
  WHERE o_orderdate < TIMESTAMP '{CUT}' GROUP BY 1),
b AS (SELECT o_custkey, max(o_orderdate) AS last_order, count(*) AS n_orders FROM orders
  WHERE o_orderdate >= TIMESTAMP '{CUT}' GROUP BY 1)
SELECT coalesce(s.o_custkey, b.o_custkey) AS o_custkey, coalesce(b.last_order, s.last_order) AS last_order,
  coalesce(s.n_orders, b.n_orders) AS n_orders FROM s FULL JOIN b ON s.o_custkey = b.o_custkey""",
)
def upsert_some_columns(t: Tables) -> DataFrame:
    old, new = _order_counts(t)
    return incremental.upsert(old, new, ["o_custkey"], update_cols=["last_order"])


def _order_counts(t: Tables) -> tuple[DataFrame, DataFrame]:
    cut = F.lit(CUT).cast("timestamp_ntz")

    def counted(df: DataFrame) -> DataFrame:
        return df.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_order"), F.count(F.lit(1)).alias("n_orders"))

    return counted(t.orders.filter(F.col("o_orderdate") < cut)), counted(t.orders.filter(F.col("o_orderdate") >= cut))


@query(
    "delete_where",
    """SELECT * FROM part WHERE NOT coalesce(p_name LIKE 'red%' OR nullif(p_size, 25) >= 45, false)""",
)
def delete_where(t: Tables) -> DataFrame:
    size = F.nullif(F.col("p_size"), F.lit(25))
    return incremental.delete_where(t.part, F.col("p_name").like("red%") | (size >= 45))


EVOLVED = """SELECT o_orderkey, {old} o_orderpriority, NULL AS note FROM orders WHERE o_orderdate < TIMESTAMP '{cut}'
UNION ALL SELECT o_orderkey, {none} o_orderpriority, lower(o_orderstatus) AS note FROM orders
WHERE o_orderdate >= TIMESTAMP '{cut}'"""


@query("evolve_append_new", EVOLVED.format(old="o_orderstatus,", none="NULL AS o_orderstatus,", cut=CUT))
def evolve_append_new(t: Tables) -> DataFrame:
    return _evolved(t, "append_new")


@query("evolve_sync_all", EVOLVED.format(old="", none="", cut=CUT))
def evolve_sync_all(t: Tables) -> DataFrame:
    return _evolved(t, "sync_all")


def _evolved(t: Tables, mode: str) -> DataFrame:
    cut = F.lit(CUT).cast("timestamp_ntz")
    stored = t.orders.filter(F.col("o_orderdate") < cut).select("o_orderkey", "o_orderstatus", "o_orderpriority")
    batch = t.orders.filter(F.col("o_orderdate") >= cut).select(
        "o_orderkey", "o_orderpriority", F.lower("o_orderstatus").alias("note")
    )
    return incremental.delete_insert(stored, batch, ["o_orderkey"], mode)


# keys are text with padding on one side and numbers on the other
@query(
    "prune_keys",
    """SELECT o_orderkey, ' ' || o_custkey || ' ' AS customer_key FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
)
def prune_keys(t: Tables) -> DataFrame:
    target = t.orders.select("o_orderkey", F.concat(F.lit(" "), "o_custkey", F.lit(" ")).alias("customer_key"))
    return prune.prune(target, t.customer.filter("c_acctbal >= 0"), "customer_key", "c_custkey")


@query(
    "prune_keys_as_stored",
    """SELECT o_orderkey, customer_key FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN ' ' || o_custkey
  ELSE CAST(o_custkey AS VARCHAR) END AS customer_key FROM orders)
WHERE customer_key IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)""",
)
def prune_keys_as_stored(t: Tables) -> DataFrame:
    key = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" "), "o_custkey")).otherwise(F.col("o_custkey").cast("string"))
    return prune.prune(t.orders.select("o_orderkey", key.alias("customer_key")), t.customer, "customer_key", "c_custkey", True)


# ---- history


SCD_TEXT = "md5(CAST({k} AS VARCHAR) || '|' || CAST({u} AS VARCHAR))"
CHANGES = f"""
changes AS (SELECT o_custkey, o_orderdate, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2)"""


@query(
    "scd2_history",
    f"""WITH {CHANGES}
SELECT o_custkey, o_orderdate, {SCD_TEXT.format(k="o_custkey", u="o_orderdate")} AS dbt_scd_id,
  o_orderdate AS dbt_updated_at, o_orderdate AS dbt_valid_from,
  lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS dbt_valid_to FROM changes""",
)
def scd2_history(t: Tables) -> DataFrame:
    return history.scd2_build(t.orders.select("o_custkey", "o_orderdate"), "o_custkey", "o_orderdate")


def _state(t: Tables, upto: str | None) -> DataFrame:
    df = t.orders if upto is None else t.orders.filter(F.col("o_orderdate") < F.lit(upto).cast("timestamp_ntz"))
    return df.groupBy("o_custkey").agg(
        F.max("o_orderdate").alias("changed_at"), F.count(F.lit(1)).alias("n_orders")
    )


STATES = f"""
s1 AS (SELECT o_custkey, max(o_orderdate) AS changed_at, count(*) AS n_orders FROM orders
  WHERE o_orderdate < TIMESTAMP '{CUT}' GROUP BY 1),
s2 AS (SELECT o_custkey, max(o_orderdate) AS changed_at, count(*) AS n_orders FROM orders GROUP BY 1)"""


# errors have no user: one key more, NULL; the last snapshot brings nothing new
@query(
    "scd2_null_keys",
    """WITH e AS (SELECT CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS k, ts FROM events),
s1 AS (SELECT k, max(ts) AS changed_at, count(*) AS n FROM e WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1),
s2 AS (SELECT k, max(ts) AS changed_at, count(*) AS n FROM e GROUP BY 1)
SELECT s1.k, s1.changed_at, s1.n, CASE WHEN s2.changed_at > s1.changed_at THEN s2.changed_at END AS dbt_valid_to
FROM s1 JOIN s2 ON s1.k IS NOT DISTINCT FROM s2.k
UNION ALL SELECT s2.k, s2.changed_at, s2.n, NULL FROM s2 LEFT JOIN s1 ON s1.k IS NOT DISTINCT FROM s2.k
WHERE s1.changed_at IS NULL OR s2.changed_at > s1.changed_at""",
)
def scd2_null_keys(t: Tables) -> DataFrame:
    events = t.events.select(F.expr("CASE WHEN event_type = 'error' THEN NULL ELSE user_id END").alias("k"), "ts")

    def state(rows: DataFrame) -> DataFrame:
        return rows.groupBy("k").agg(F.max("ts").alias("changed_at"), F.count("*").alias("n"))

    early, now = state(events.filter(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))), state(events)
    rows = None
    for current in (early, now, now):
        rows = history.scd2_apply(rows, current, "k", "changed_at", RUN_TS)
    return rows.select("k", "changed_at", "n", names.SCD_VALID_TO)


@query(
    "scd2_snapshot",
    f"""WITH {STATES},
v AS (
  SELECT s1.*, CASE WHEN s2.changed_at > s1.changed_at THEN s2.changed_at END AS dbt_valid_to
  FROM s1 LEFT JOIN s2 ON s1.o_custkey = s2.o_custkey
  UNION ALL
  SELECT s2.*, NULL FROM s2 LEFT JOIN s1 ON s1.o_custkey = s2.o_custkey
  WHERE s1.o_custkey IS NULL OR s2.changed_at > s1.changed_at)
SELECT o_custkey, changed_at, n_orders, {SCD_TEXT.format(k="o_custkey", u="changed_at")} AS dbt_scd_id,
  changed_at AS dbt_updated_at, changed_at AS dbt_valid_from, dbt_valid_to FROM v""",
)
def scd2_snapshot(t: Tables) -> DataFrame:
    first = history.scd2_start(_state(t, CUT), "o_custkey", "changed_at")
    return history.scd2_apply(first, _state(t, None), "o_custkey", "changed_at", RUN_TS)


# customers in debt leave the source between the first and the second snapshot
@query(
    "scd2_hard_delete",
    f"""WITH {STATES},
alive AS (SELECT s2.* FROM s2 JOIN customer ON o_custkey = c_custkey WHERE c_acctbal >= 0),
v AS (
  SELECT s1.*, CASE WHEN a.o_custkey IS NULL THEN {TS}
    WHEN a.changed_at > s1.changed_at THEN a.changed_at END AS dbt_valid_to
  FROM s1 LEFT JOIN alive a ON s1.o_custkey = a.o_custkey
  UNION ALL
  SELECT a.*, NULL FROM alive a LEFT JOIN s1 ON s1.o_custkey = a.o_custkey
  WHERE s1.o_custkey IS NULL OR a.changed_at > s1.changed_at)
SELECT o_custkey, changed_at, n_orders, {SCD_TEXT.format(k="o_custkey", u="changed_at")} AS dbt_scd_id,
  changed_at AS dbt_updated_at, changed_at AS dbt_valid_from, dbt_valid_to FROM v""",
)
def scd2_hard_delete(t: Tables) -> DataFrame:
    first = history.scd2_start(_state(t, CUT), "o_custkey", "changed_at")
    alive = prune.prune(_state(t, None), t.customer.filter("c_acctbal >= 0"), "o_custkey", "c_custkey")
    return history.scd2_apply(first, alive, "o_custkey", "changed_at", RUN_TS)


@query(
    "snap_stg_customers",
    f"""WITH activity AS (SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order,
  max(o_orderdate) FILTER (o_orderdate < TIMESTAMP '{CUT}') AS then_order FROM orders GROUP BY 1),
c AS (SELECT c_custkey AS customer_id, c_name AS customer_name, lower(c_name) || '@example.com' AS email,
  first_order AS created_at, last_order, then_order FROM customer LEFT JOIN activity ON c_custkey = o_custkey),
v AS (
  SELECT customer_id, customer_name, email, created_at, then_order AS _airbyte_extracted_at,
    CASE WHEN last_order > then_order THEN last_order END AS dbt_valid_to FROM c WHERE then_order IS NOT NULL
  UNION ALL
  SELECT customer_id, customer_name, email, created_at, last_order, NULL FROM c
  WHERE then_order IS NULL OR last_order > then_order)
SELECT *, {SCD_TEXT.format(k="customer_id", u="coalesce(CAST(_airbyte_extracted_at AS VARCHAR), '')")} AS dbt_scd_id,
  _airbyte_extracted_at AS dbt_updated_at, _airbyte_extracted_at AS dbt_valid_from FROM v""",
)
def snap_stg_customers(t: Tables) -> DataFrame:
    from strata.plans import bronze, retail

    now = retail.stg_customers_batch(bronze.customers(t), None, RUN_TS)
    seen = t.orders.filter(F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz")).groupBy(
        F.col("o_custkey").alias("customer_id")
    )
    then = now.drop(names.EXTRACTED_AT).join(seen.agg(F.max("o_orderdate").alias(names.EXTRACTED_AT)), "customer_id")
    return retail.snap_stg_customers(retail.snap_stg_customers(None, then, RUN_TS), now, RUN_TS)
