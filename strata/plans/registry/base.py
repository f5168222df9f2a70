"""Registration of queries, and the SQL that describes the raw tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans.bronze import Tables

ENTRIES: dict[str, tuple[Callable[[Tables], DataFrame], str | None]] = {}

RUN_TS = datetime(2024, 2, 1)
EARLIER_RUN = datetime(2001, 1, 10)
CUT = "2001-01-01"
SEGMENTS = [(350_000, "high"), (150_000, "medium")]
DEALS = [(70_000, "large"), (30_000, "medium")]


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        ENTRIES[name] = (build, sql)
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that results compare alike whatever reads them."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


def average(cents: str, n: str) -> str:
    """SQL for an average of whole cents, rounded half up to six digits."""
    return f"CAST((2 * ({cents}) * 10000 + ({n})) // (2 * ({n})) AS DOUBLE) / 1e6"


TS = f"TIMESTAMP '{RUN_TS}'"
EARLIER_TS = f"TIMESTAMP '{EARLIER_RUN}'"

ACTIVITY = """
activity AS (
  SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey
)"""

STG_CUSTOMERS = (
    ACTIVITY
    + f""",
stg_customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, lower(c_name) || '@example.com' AS email,
         first_order AS created_at, last_order AS _airbyte_extracted_at, {TS} AS dbt_updated_at
  FROM customer LEFT JOIN activity ON c_custkey = o_custkey
)"""
)

STG_ORDERS = f"""
stg_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
         CAST(o_totalprice AS DECIMAL(18, 2)) AS order_amount, lower(o_orderstatus) AS order_status,
         o_orderdate AS _airbyte_extracted_at, {TS} AS dbt_updated_at
  FROM orders
)"""

INT_ORDERS = (
    STG_ORDERS
    + """,
int_orders AS (
  SELECT order_id, customer_id, order_date, CAST(order_date AS DATE) AS order_date_key, order_amount, order_status,
         CASE WHEN order_amount >= 350000 THEN 'high' WHEN order_amount >= 150000 THEN 'medium' ELSE 'low' END
           AS order_value_segment,
         _airbyte_extracted_at
  FROM stg_orders
)"""
)

DIM_CUSTOMER = (
    STG_CUSTOMERS
    + f""",
dim_customer AS (
  SELECT customer_id, customer_name, email, created_at AS customer_created_at,
         CAST(date_trunc('month', created_at) AS TIMESTAMP) AS customer_cohort_month, {TS} AS dbt_updated_at
  FROM stg_customers
)"""
)

MART_SALES = (
    DIM_CUSTOMER
    + ","
    + INT_ORDERS
    + f""",
mart AS (
  SELECT CAST(date_trunc('month', order_date) AS TIMESTAMP) AS order_month, o.customer_id, customer_name,
         customer_cohort_month, order_status, order_value_segment, count(*) AS order_count,
         CAST(sum(order_amount) AS DOUBLE) AS total_revenue,
         {average("sum(CAST(order_amount * 100 AS HUGEINT))", "count(*)")} AS avg_order_value,
         CAST(min(order_amount) AS DOUBLE) AS min_order_value, CAST(max(order_amount) AS DOUBLE) AS max_order_value,
         {TS} AS dbt_updated_at
  FROM int_orders o JOIN dim_customer c ON o.customer_id = c.customer_id
  GROUP BY 1, 2, 3, 4, 5, 6
)"""
)

STG_MATERIAL = f"""
stg_material AS (
  SELECT CAST(p_partkey AS VARCHAR) AS material_number, p_name AS material_description,
         upper(p_type) AS material_group, p_brand AS product_hierarchy, 'MT' AS base_uom,
         'P' || p_size AS plant_code, TIMESTAMP '1995-01-01' + to_days(p_size) AS updated_at,
         TIMESTAMP '1995-01-01' + to_days(p_size) AS _airbyte_extracted_at, {TS} AS dbt_updated_at
  FROM part
)"""

STG_PARTNER = (
    ACTIVITY
    + f""",
stg_partner AS (
  SELECT CAST(c_custkey AS VARCHAR) AS partner_number, c_name AS partner_name, upper(n_name) AS country_code,
         r_name AS region, c_mktsegment AS industry_sector, upper(c_mktsegment) AS customer_group,
         first_order AS updated_at, last_order AS _airbyte_extracted_at, {TS} AS dbt_updated_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       LEFT JOIN activity ON c_custkey = o_custkey
)"""
)

STG_SALES_ORDER = f"""
stg_sales_order AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS sales_order_number, CAST(o_custkey AS VARCHAR) AS partner_number,
         CAST(o_orderdate AS DATE) AS order_date, CAST(CAST(o_orderdate AS DATE) + 14 AS DATE) AS requested_delivery_date,
         upper(o_orderpriority) AS sales_organization, '10' AS distribution_channel, '01' AS division,
         'THB' AS currency_code, upper(trim(substr(o_orderpriority, 3, 3))) AS incoterms,
         CASE o_orderstatus WHEN 'P' THEN 'CANCELLED' WHEN 'F' THEN 'COMPLETED' ELSE 'OPEN' END AS order_status,
         o_orderdate AS changed_at, o_orderdate AS _airbyte_extracted_at, {TS} AS dbt_updated_at
  FROM orders
)"""

STG_ITEM = f"""
items_raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS sales_order_number, lpad(CAST(l_linenumber * 10 AS VARCHAR), 6, '0') AS item_number,
         CAST(l_partkey AS VARCHAR) AS material_number, upper(l_returnflag) AS plant_code,
         CAST(l_quantity AS DECIMAL(13, 3)) AS order_quantity_mt, CAST(l_extendedprice AS DECIMAL(15, 2)) AS net_value,
         l_shipdate
  FROM lineitem
),
stg_item AS (
  SELECT sales_order_number || '-' || item_number AS sales_order_item_key, sales_order_number, item_number,
         material_number, plant_code, order_quantity_mt, net_value, 'THB' AS currency_code,
         l_shipdate AS item_changed_at, l_shipdate AS _airbyte_extracted_at, {TS} AS dbt_updated_at
  FROM (SELECT *, row_number() OVER (PARTITION BY sales_order_number, item_number
               ORDER BY l_shipdate DESC NULLS LAST, material_number DESC NULLS LAST, plant_code DESC NULLS LAST,
                        order_quantity_mt DESC NULLS LAST, net_value DESC NULLS LAST) AS rn FROM items_raw)
  WHERE rn = 1
)"""

LINES = (
    ",".join([STG_ITEM, STG_SALES_ORDER, STG_MATERIAL, STG_PARTNER])
    + """,
lines AS (
  SELECT i.sales_order_item_key, i.sales_order_number, i.item_number, i.material_number, m.material_description,
         m.material_group, m.product_hierarchy, i.plant_code, o.partner_number, p.partner_name, p.country_code,
         p.customer_group, p.industry_sector, o.order_date, o.order_date AS order_date_key, o.sales_organization,
         o.currency_code AS header_currency_code, i.currency_code AS line_currency_code, o.incoterms, o.order_status,
         i.order_quantity_mt, i.net_value,
         CASE WHEN i.order_quantity_mt > 0 THEN
           (2 * CAST(i.net_value * 100 AS HUGEINT) * 1000 + CAST(i.order_quantity_mt * 1000 AS HUGEINT))
             // (2 * CAST(i.order_quantity_mt * 1000 AS HUGEINT)) END AS unit_price_cents,
         CASE WHEN i.net_value >= 70000 THEN 'large' WHEN i.net_value >= 30000 THEN 'medium' ELSE 'standard' END
           AS deal_size_segment,
         i._airbyte_extracted_at
  FROM stg_item i JOIN stg_sales_order o ON i.sales_order_number = o.sales_order_number
       JOIN stg_material m ON i.material_number = m.material_number
       JOIN stg_partner p ON o.partner_number = p.partner_number
)"""
)

LINE_COLUMNS = """sales_order_item_key, sales_order_number, item_number, material_number, material_description,
  material_group, product_hierarchy, plant_code, partner_number, partner_name, country_code, customer_group,
  industry_sector, order_date, order_date_key, sales_organization, header_currency_code, line_currency_code, incoterms,
  order_status, CAST(order_quantity_mt AS DOUBLE) AS order_quantity_mt, CAST(net_value AS DOUBLE) AS net_value,
  CAST(unit_price_cents AS DOUBLE) / 100 AS unit_price_per_mt, deal_size_segment"""

STG_COUNTRIES = (
    ACTIVITY
    + f""",
country_rows AS (
  SELECT CAST(c_custkey AS VARCHAR) AS country_id, upper(n_name) || '-' || upper(c_mktsegment) AS country_code,
         rpad(c_name, CAST(19 + floor(c_acctbal / 1000) AS INTEGER), 'x') AS country_name,
         CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal) AS BIGINT) END AS import_sequence_number,
         CASE WHEN c_acctbal < 1000 THEN 1 WHEN c_acctbal < 9000 THEN 0 END AS state_code,
         CASE WHEN c_acctbal < 5000 THEN 1 ELSE 2 END AS status_code,
         last_order AS bronze_loaded_at, {TS} AS dbt_updated_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN activity ON c_custkey = o_custkey
),
stg_countries AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY country_code
             ORDER BY length(country_name) DESC NULLS FIRST, bronze_loaded_at DESC NULLS FIRST,
                      country_id DESC NULLS LAST) AS rn FROM country_rows)
  WHERE rn = 1
)"""
)
