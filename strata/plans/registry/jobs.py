"""The three jobs, run whole over the test tables into a store of their own."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import columns as names
from strata.plans import bronze, countries, retail, sap
from strata.plans.bronze import Tables
from strata.plans.registry import base
from strata.plans.registry.base import CUT, RUN_TS, TS, query
from strata.session import checkpoint_root
from strata.sources.landing import WATERMARKS
from strata.sources.store import TableStore


FINISHED: dict[tuple[str, str, str], TableStore] = {}


def fresh_store(t: Tables) -> TableStore:
    return TableStore(t.spark, f"{checkpoint_root(t.spark)}/jobs-{uuid.uuid4().hex}")


# the jobs use the published thresholds, not the ones that split the test data
REBUILT_MART = base.MART_SALES.replace("350000", "1000").replace("150000", "100")
#: SQL for the first month that the second of two syncs builds anew; earlier ones stay as the first sync built them.
REFRESHED = f"""(SELECT date_trunc('month', max(o_orderdate) - INTERVAL 3 DAYS) FROM orders WHERE o_orderdate < TIMESTAMP '{CUT}')"""
RETAIL_MART = REBUILT_MART + f""",
kept_up AS (
  SELECT * REPLACE (CASE WHEN order_month >= {REFRESHED} THEN {TS} ELSE TIMESTAMP '{CUT}' END AS dbt_updated_at) FROM mart
)"""


#: Customers without orders have no dates in the test data; they get one, so that none is left out.
NO_DATE = "1998-08-01"


def dated(df: DataFrame, *columns: str) -> DataFrame:
    stand_in = F.lit(NO_DATE).cast("timestamp_ntz")
    return df.withColumns({c: F.coalesce(c, stand_in) for c in columns})


def run_retail_twice(t: Tables, **options) -> TableStore:
    """Two syncs: what was there before the cut, then everything. The second run is incremental."""
    store = fresh_store(t)
    now = {"customers": dated(bronze.customers(t), "created_at", names.EXTRACTED_AT), "orders": bronze.orders(t)}
    cut = F.lit(CUT).cast("timestamp_ntz")
    earlier = now["orders"].filter(F.col("order_date") < cut)
    seen = earlier.groupBy(F.col("customer_id").alias("id")).agg(F.max("order_date").alias(names.EXTRACTED_AT))
    then = {"customers": now["customers"].drop(names.EXTRACTED_AT).join(seen, "id"), "orders": earlier}
    retail.run_retail(then, store, datetime.fromisoformat(CUT), load_sources=True, **options)
    retail.run_retail(now, store, RUN_TS, load_sources=True, **options)
    return store


def finished(t: Tables, job: str) -> TableStore:
    """The store that a job left, for queries that only look at what it wrote: run once per session and folder."""
    runs = {"retail": lambda: run_retail_twice(t, catalog=True), "sap": lambda: run_sap(t)}
    key = (t.spark.sparkContext.applicationId, t.folder, job)
    if key not in FINISHED:
        FINISHED[key] = runs[job]()
    return FINISHED[key]


@query("retail_job", f"WITH {RETAIL_MART} SELECT * FROM kept_up")
def retail_job(t: Tables) -> DataFrame:
    """From the sources to the published copies."""
    return run_retail_twice(t).read(f"{retail.GOLD}/mart_sales_performance")


@query(
    "retail_watermark",
    f"""WITH c AS (SELECT c_custkey, coalesce(min(o_orderdate), TIMESTAMP '{NO_DATE}') AS created_at, min(o_orderdate) AS first_order
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1)
SELECT 'src_local_postgres' AS bronze_schema, 'load-src_local_postgres' AS connection_id,
  CAST(NULL AS VARCHAR) AS pipeline_id, {TS} AS synced_at, CAST(NULL AS BIGINT) AS job_id, n AS records_emitted,
  n AS records_committed FROM (SELECT
    (SELECT count(*) FROM c WHERE created_at >= (SELECT max(created_at) FROM c WHERE first_order < TIMESTAMP '{CUT}'))
    + (SELECT count(*) FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '{CUT}')) AS n)""",
)
def retail_watermark(t: Tables) -> DataFrame:
    """The sync log that the job's own load stage wrote: of the second sync, which reads from the cursors on."""
    return finished(t, "retail").read(WATERMARKS)


def published(text: str) -> str:
    """SQL for an instant as it is published."""
    return f"strftime({text}, '%Y-%m-%dT%H:%M:%S')"


@query(
    "published_mart_sales",
    f"""WITH {RETAIL_MART} SELECT * REPLACE ({published("order_month")} AS order_month,
  {published("customer_cohort_month")} AS customer_cohort_month, {published("dbt_updated_at")} AS dbt_updated_at) FROM kept_up""",
)
def published_mart_sales(t: Tables) -> DataFrame:
    """The copy of the mart. Rows of the first run stay unless the second one has their key, which here it always has."""
    return finished(t, "retail").read(f"published/{retail.GOLD}/mart_sales_performance")


FACT = f"""WITH {base.INT_ORDERS.replace("350000", "1000").replace("150000", "100")}
SELECT order_id, customer_id, {{date}} AS order_date, {{key}} AS order_date_key,
  CAST(order_amount AS DOUBLE) AS order_amount, order_status, order_value_segment FROM int_orders"""
FACT_COLUMNS = ["order_id", "customer_id", "order_date", "order_date_key", "order_amount", "order_status", "order_value_segment"]


@query("published_fct_orders", FACT.format(date=published("order_date"), key="strftime(order_date_key, '%Y-%m-%d')"))
def published_fct_orders(t: Tables) -> DataFrame:
    return finished(t, "retail").read(f"published/{retail.GOLD}/fct_orders").select(*FACT_COLUMNS)


@query("catalog_fact", FACT.format(date="order_date", key="order_date_key"))
def catalog_fact(t: Tables) -> DataFrame:
    """The merged fact, by its name in the catalog."""
    store = finished(t, "retail")
    # another run of the job may have pointed the name elsewhere
    store.publish_to_catalog(f"{retail.GOLD}/fct_orders", f"{retail.GOLD}.fct_orders")
    return t.spark.table(f"{retail.GOLD}.fct_orders").select(*FACT_COLUMNS)


SAP_LINES = base.LINES.replace("70000", "500000").replace("30000", "100000")


@query(
    "sap_job",
    f"""WITH {SAP_LINES}
SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_month, material_group, product_hierarchy, plant_code,
  sales_organization, country_code, customer_group, order_status, deal_size_segment, count(*) AS line_count,
  count(DISTINCT sales_order_number) AS order_count, count(DISTINCT partner_number) AS customer_count,
  CAST(sum(order_quantity_mt) AS DOUBLE) AS total_quantity_mt, CAST(sum(net_value) AS DOUBLE) AS total_net_value,
  {base.average("sum(unit_price_cents)", "count(unit_price_cents)")} AS avg_unit_price_per_mt, {TS} AS dbt_updated_at
FROM lines WHERE order_status <> 'CANCELLED' GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9""",
)
def sap_job(t: Tables) -> DataFrame:
    return run_sap(t).read(f"{sap.GOLD}/mart_sap_chemical_sales_performance")


def run_sap(t: Tables) -> TableStore:
    store = fresh_store(t)
    raw = {
        "sap_material": bronze.sap_material(t),
        "sap_business_partner": dated(bronze.sap_business_partner(t), "updated_at", names.EXTRACTED_AT),
        "sap_sales_order": bronze.sap_sales_order(t),
        "sap_sales_order_item": bronze.sap_sales_order_item(t),
    }
    sap.run_sap(raw, store, RUN_TS, load_sources=True)
    return store


@query(
    "published_sap_lines",
    f"""WITH {SAP_LINES}
SELECT * REPLACE (strftime(order_date, '%Y-%m-%d') AS order_date, strftime(order_date_key, '%Y-%m-%d') AS order_date_key)
FROM (SELECT {base.LINE_COLUMNS} FROM lines)""",
)
def published_sap_lines(t: Tables) -> DataFrame:
    copy = finished(t, "sap").read(f"published/{sap.GOLD}/fct_sap_sales_lines")
    return copy.drop(names.BUILT_AT, names.LAST_EXTRACTED_AT)


# ---- marts kept up over three syncs, held against one built from all rows


def stamped_rows(df: DataFrame, at: datetime, changed) -> DataFrame:
    """The rows with ``at`` as extraction time where they changed."""
    return df.withColumn(names.EXTRACTED_AT, F.when(changed, F.lit(str(at)).cast("timestamp_ntz")).otherwise(F.col(names.EXTRACTED_AT)))


def run_retail_syncs(t: Tables, store: TableStore) -> TableStore:
    """Old orders; then all, some of the old ones changed; then customers in debt leave with their orders, and some get a new name."""
    first, second, third = datetime.fromisoformat(CUT), datetime(2023, 12, 1), datetime(2024, 2, 1)
    customers, orders = dated(bronze.customers(t), "created_at", names.EXTRACTED_AT), bronze.orders(t)
    customers = customers.withColumn(names.EXTRACTED_AT, F.lit(str(first)).cast("timestamp_ntz"))
    orders = orders.withColumn(names.EXTRACTED_AT, F.col("order_date"))
    cut = F.lit(CUT).cast("timestamp_ntz")
    recent = (F.col("order_date") < cut) & (F.col("order_date") >= cut - F.expr("INTERVAL 2 DAYS"))
    earlier = orders.filter(F.col("order_date") < cut).withColumn("amount", F.when(recent, F.lit(1).cast("decimal(18,2)")).otherwise(F.col("amount")))
    retail.run_retail({"customers": customers, "orders": earlier}, store, first, publications=[])
    retail.run_retail({"customers": customers, "orders": stamped_rows(orders, second, recent)}, store, second, publications=[])
    solvent = t.customer.filter("c_acctbal >= 0").select(F.col("c_custkey").alias("id"))
    renamed = F.col("id") % 7 == 0
    named = stamped_rows(customers, third, renamed).withColumn("name", F.when(renamed, F.concat("name", F.lit(" II"))).otherwise(F.col("name")))
    left = {
        "customers": named.join(solvent, "id", "left_semi"),
        "orders": orders.join(solvent.withColumnRenamed("id", "customer_id"), "customer_id", "left_semi").select(orders.columns),
    }
    retail.run_retail(left, store, third, publications=[])
    return store


@query(
    "mart_incremental",
    f"""WITH {REBUILT_MART}
SELECT mart.* EXCLUDE (dbt_updated_at) REPLACE (customer_name || CASE WHEN customer_id % 7 = 0 THEN ' II' ELSE '' END AS customer_name)
FROM mart JOIN customer ON customer_id = c_custkey AND c_acctbal >= 0""",
)
def mart_incremental(t: Tables) -> DataFrame:
    return run_retail_syncs(t, fresh_store(t)).read(retail.MART).drop(names.BUILT_AT)


def run_sap_syncs(t: Tables, store: TableStore) -> TableStore:
    """Orders and lines as they come in, by their cursors, over three syncs. Lines may ship years before or after the order, so
    runs look back that far."""
    raw = {
        "sap_material": bronze.sap_material(t).drop(names.EXTRACTED_AT),
        "sap_business_partner": dated(bronze.sap_business_partner(t), "updated_at").drop(names.EXTRACTED_AT),
        "sap_sales_order": bronze.sap_sales_order(t).drop(names.EXTRACTED_AT),
        "sap_sales_order_item": bronze.sap_sales_order_item(t).drop(names.EXTRACTED_AT),
    }
    for at in (datetime(1996, 1, 1), datetime(1997, 1, 1), RUN_TS):
        until = F.lit(str(at)).cast("timestamp_ntz")
        seen = {**raw, **{n: raw[n].filter(F.col(c) < until) for n, c in (("sap_sales_order", "changed_at"), ("sap_sales_order_item", "item_changed_at"))}}
        sap.run_sap(seen, store, at, load_sources=True, publications=[], days=4000)
    return store


@query(
    "sap_mart_incremental",
    f"""WITH {SAP_LINES}
SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_month, material_group, product_hierarchy, plant_code,
  sales_organization, country_code, customer_group, order_status, deal_size_segment, count(*) AS line_count,
  count(DISTINCT sales_order_number) AS order_count, count(DISTINCT partner_number) AS customer_count,
  CAST(sum(order_quantity_mt) AS DOUBLE) AS total_quantity_mt, CAST(sum(net_value) AS DOUBLE) AS total_net_value,
  {base.average("sum(unit_price_cents)", "count(unit_price_cents)")} AS avg_unit_price_per_mt
FROM lines WHERE order_status <> 'CANCELLED' GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9""",
)
def sap_mart_incremental(t: Tables) -> DataFrame:
    return run_sap_syncs(t, fresh_store(t)).read(sap.MART).drop(names.BUILT_AT)


# ---- the other copies that a run publishes


@query(
    "published_dim_customer",
    f"""WITH {base.DIM_CUSTOMER.replace("first_order AS created_at", f"coalesce(first_order, TIMESTAMP '{NO_DATE}') AS created_at")}
SELECT customer_id, customer_name, email, {published("customer_created_at")} AS customer_created_at,
  {published("customer_cohort_month")} AS customer_cohort_month FROM dim_customer""",
)
def published_dim_customer(t: Tables) -> DataFrame:
    return finished(t, "retail").read(f"published/{retail.GOLD}/dim_customer").drop(names.BUILT_AT)


@query(
    "published_dim_date",
    """SELECT strftime(day, '%Y-%m-%d') AS date_key, CAST(year(day) AS INTEGER) AS year_number,
  CAST(month(day) AS INTEGER) AS month_number, CAST(dayofweek(day) AS INTEGER) AS day_of_week
FROM (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day FROM orders)""",
)
def published_dim_date(t: Tables) -> DataFrame:
    copy = finished(t, "retail").read(f"published/{retail.GOLD}/dim_date")
    return copy.select("date_key", "year_number", "month_number", "day_of_week")


@query(
    "published_dim_sap_material",
    f"""WITH {base.STG_MATERIAL} SELECT material_number, material_description, material_group, product_hierarchy, base_uom,
  plant_code, {published("updated_at")} AS updated_at FROM stg_material""",
)
def published_dim_sap_material(t: Tables) -> DataFrame:
    copy = finished(t, "sap").read(f"published/{sap.GOLD}/dim_sap_material")
    return copy.drop(names.BUILT_AT, names.LAST_EXTRACTED_AT)


@query(
    "published_dim_sap_customer",
    f"""WITH {base.STG_PARTNER} SELECT partner_number, partner_name, country_code, region, industry_sector, customer_group,
  strftime(date_trunc('month', coalesce(updated_at, TIMESTAMP '{NO_DATE}')), '%Y-%m-%d') AS partner_since_month,
  {published(f"coalesce(updated_at, TIMESTAMP '{NO_DATE}')")} AS updated_at FROM stg_partner""",
)
def published_dim_sap_customer(t: Tables) -> DataFrame:
    copy = finished(t, "sap").read(f"published/{sap.GOLD}/dim_sap_customer")
    return copy.drop(names.BUILT_AT, names.LAST_EXTRACTED_AT)


@query(
    "published_mart_sap",
    f"""WITH {SAP_LINES}
SELECT strftime(date_trunc('month', order_date), '%Y-%m-%d') AS order_month, material_group, product_hierarchy, plant_code,
  sales_organization, country_code, customer_group, order_status, deal_size_segment, count(*) AS line_count,
  count(DISTINCT sales_order_number) AS order_count, count(DISTINCT partner_number) AS customer_count,
  CAST(sum(order_quantity_mt) AS DOUBLE) AS total_quantity_mt, CAST(sum(net_value) AS DOUBLE) AS total_net_value
FROM lines WHERE order_status <> 'CANCELLED' GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9""",
)
def published_mart_sap(t: Tables) -> DataFrame:
    copy = finished(t, "sap").read(f"published/{sap.MART}")
    return copy.drop(names.BUILT_AT, "avg_unit_price_per_mt")


@query(
    "countries_job",
    f"""WITH {base.STG_COUNTRIES} SELECT * EXCLUDE (bronze_loaded_at, dbt_updated_at),
  (state_code = 0 AND status_code = 1) AS is_active,
  strftime(bronze_loaded_at, '%Y-%m-%dT%H:%M:%S') AS last_loaded_at, '{RUN_TS.isoformat()}' AS dbt_updated_at
FROM stg_countries""",
)
def countries_job(t: Tables) -> DataFrame:
    store = fresh_store(t)
    countries.run_countries(bronze.countries(t), store, RUN_TS, load_sources=True)
    return store.read(f"published/{countries.GOLD}/dim_country")
