"""The models of the three pipelines over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import columns as names
from strata.functions.time import as_instant
from strata.operators import joins
from strata.operators.ranking import top_k
from strata.plans import bronze, countries, retail, sap
from strata.plans.bronze import Tables
from strata.plans.registry import base
from strata.plans.registry.base import CUT, DEALS, EARLIER_RUN, EARLIER_TS, RUN_TS, SEGMENTS, TS, query

# ---- retail


def silver_customers(t: Tables) -> DataFrame:
    return retail.stg_customers_batch(bronze.customers(t), None, RUN_TS)


def silver_orders(t: Tables) -> DataFrame:
    return retail.stg_orders_batch(bronze.orders(t), None, RUN_TS)


def enriched_orders(t: Tables) -> DataFrame:
    return retail.int_orders_enriched(silver_orders(t), SEGMENTS)


def before_cut(df: DataFrame, col: str) -> DataFrame:
    """What was there at an earlier time."""
    return df.filter(as_instant(col) < F.lit(CUT).cast("timestamp_ntz"))


@query("stg_customers", f"WITH {base.STG_CUSTOMERS} SELECT * FROM stg_customers")
def stg_customers(t: Tables) -> DataFrame:
    return retail.stg_customers(bronze.customers(t), None, RUN_TS)


@query(
    "stg_orders",
    f"WITH {base.STG_ORDERS} SELECT * REPLACE (CAST(order_amount AS DOUBLE) AS order_amount) FROM stg_orders",
)
def stg_orders(t: Tables) -> DataFrame:
    return retail.stg_orders(bronze.orders(t), None, RUN_TS)


@query(
    "stg_orders_incremental",
    f"""WITH {base.STG_ORDERS},
bound AS (SELECT max(order_date) - INTERVAL 3 DAYS AS b FROM stg_orders WHERE order_date < TIMESTAMP '{CUT}')
SELECT * EXCLUDE (b) REPLACE (CAST(order_amount AS DOUBLE) AS order_amount,
  CASE WHEN order_date >= b THEN dbt_updated_at ELSE {EARLIER_TS} END AS dbt_updated_at)
FROM stg_orders, bound""",
)
def stg_orders_incremental(t: Tables) -> DataFrame:
    raw = bronze.orders(t)
    earlier = retail.stg_orders_batch(before_cut(raw, "order_date"), None, EARLIER_RUN)
    return retail.stg_orders(raw, earlier, RUN_TS)


@query(
    "int_orders_enriched",
    f"WITH {base.INT_ORDERS} SELECT * REPLACE (CAST(order_amount AS DOUBLE) AS order_amount) FROM int_orders",
)
def int_orders_enriched(t: Tables) -> DataFrame:
    return enriched_orders(t)


@query("dim_customer", f"WITH {base.DIM_CUSTOMER} SELECT * FROM dim_customer")
def dim_customer(t: Tables) -> DataFrame:
    return retail.dim_customer(silver_customers(t), None, RUN_TS)


# the earlier dimension was built before the cut; customers with a negative balance have left since
@query(
    "dim_customer_incremental",
    f"""WITH {base.DIM_CUSTOMER},
sliced AS (SELECT customer_id FROM stg_customers WHERE _airbyte_extracted_at >= {EARLIER_TS} - INTERVAL 3 DAYS)
SELECT d.* REPLACE (CASE WHEN s.customer_id IS NOT NULL THEN dbt_updated_at ELSE {EARLIER_TS} END AS dbt_updated_at)
FROM dim_customer d JOIN customer ON d.customer_id = c_custkey AND c_acctbal >= 0
     LEFT JOIN sliced s ON s.customer_id = d.customer_id
WHERE s.customer_id IS NOT NULL OR d.customer_created_at < TIMESTAMP '{CUT}'""",
)
def dim_customer_incremental(t: Tables) -> DataFrame:
    silver = silver_customers(t)
    earlier = retail.dim_customer(before_cut(silver, "created_at"), None, EARLIER_RUN)
    staying = t.customer.filter("c_acctbal >= 0")
    return retail.dim_customer(joins.keep_keys(silver, staying, {"customer_id": "c_custkey"}), earlier, RUN_TS)


@query(
    "dim_date",
    f"""WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
d AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date_key FROM b)
SELECT date_key, CAST(year(date_key) AS INTEGER) AS year_number, CAST(quarter(date_key) AS INTEGER) AS quarter_number,
  CAST(month(date_key) AS INTEGER) AS month_number, CAST(weekofyear(date_key) AS INTEGER) AS week_of_year,
  CAST(dayofweek(date_key) AS INTEGER) AS day_of_week, dayname(date_key) AS day_name, monthname(date_key) AS month_name,
  dayofweek(date_key) IN (0, 6) AS is_weekend, {TS} AS dbt_updated_at FROM d""",
)
def dim_date(t: Tables) -> DataFrame:
    # straight from the raw dates: the spine needs only their bounds, not the deduplicated orders
    dates = bronze.orders(t).select(F.col("order_date").cast("date").alias("order_date_key"))
    return retail.dim_date(dates, RUN_TS)


FCT_SQL = f"""fct AS (
  SELECT order_id, customer_id, order_date, order_date_key, CAST(order_amount AS DOUBLE) AS order_amount, order_status,
         order_value_segment, _airbyte_extracted_at AS last_extracted_at, {TS} AS dbt_updated_at
  FROM int_orders)"""


@query("fct_orders", f"WITH {base.INT_ORDERS}, {FCT_SQL} SELECT * FROM fct")
def fct_orders(t: Tables) -> DataFrame:
    return retail.fct_orders(enriched_orders(t), None, RUN_TS)


# the stored fact is as of the cut and held lower amounts; orders of customers in debt have left since
@query(
    "fct_orders_incremental",
    f"""WITH {base.INT_ORDERS}, {FCT_SQL},
bound AS (SELECT max(order_date) - INTERVAL 3 DAYS AS b FROM fct WHERE order_date < TIMESTAMP '{CUT}')
SELECT fct.* REPLACE (CASE WHEN order_date >= b THEN order_amount ELSE 0 END AS order_amount,
                      CASE WHEN order_date >= b THEN dbt_updated_at ELSE {EARLIER_TS} END AS dbt_updated_at)
FROM fct CROSS JOIN bound JOIN customer ON customer_id = c_custkey AND c_acctbal >= 0""",
)
def fct_orders_incremental(t: Tables) -> DataFrame:
    now = enriched_orders(t)
    then = before_cut(now, "order_date").withColumn("order_amount", F.lit(0).cast("decimal(18,2)"))
    stored = retail.fct_orders(then, None, EARLIER_RUN)
    staying = joins.keep_keys(now, t.customer.filter("c_acctbal >= 0"), {"customer_id": "c_custkey"})
    return retail.fct_orders(staying, stored, RUN_TS)



def build_mart(t: Tables) -> DataFrame:
    fct = retail.fct_orders(enriched_orders(t), None, RUN_TS)
    return retail.mart_sales_performance(fct, retail.dim_customer(silver_customers(t), None, RUN_TS), RUN_TS)


@query("mart_sales_performance", f"WITH {base.MART_SALES} SELECT * FROM mart")
def mart_sales_performance(t: Tables) -> DataFrame:
    return build_mart(t)


@query(
    "top_revenue",
    f"""WITH {base.MART_SALES} SELECT * FROM mart
ORDER BY total_revenue DESC, customer_id, order_month, order_status, order_value_segment LIMIT 20""",
)
def top_revenue(t: Tables) -> DataFrame:
    return top_k(
        build_mart(t), "total_revenue", 20, ["customer_id", "order_month", "order_status", "order_value_segment"]
    )


@query(
    "star_query",
    f"""WITH {base.DIM_CUSTOMER}, {base.INT_ORDERS}
SELECT order_id, customer_name, monthname(order_date_key) AS month_name, CAST(order_amount AS DOUBLE) AS order_amount
FROM int_orders JOIN dim_customer USING (customer_id)""",
)
def star_query(t: Tables) -> DataFrame:
    fct = retail.fct_orders(enriched_orders(t), None, RUN_TS)
    dim = retail.dim_customer(silver_customers(t), None, RUN_TS)
    days = dim_date(t).drop(names.BUILT_AT)
    star = joins.star_query(fct.drop(names.BUILT_AT), dim.drop(names.BUILT_AT), days)
    return star.select("order_id", "customer_name", "month_name", "order_amount")


# ---- chemical sales


def sap_silver(t: Tables) -> dict[str, DataFrame]:
    return {
        "materials": sap.stg_sap_material_batch(bronze.sap_material(t), None, RUN_TS),
        "partners": sap.stg_sap_business_partner_batch(bronze.sap_business_partner(t), None, RUN_TS),
        "orders": sap.stg_sap_sales_order_batch(bronze.sap_sales_order(t), None, RUN_TS),
        "items": sap.stg_sap_sales_order_item_batch(bronze.sap_sales_order_item(t), None, RUN_TS),
    }


def sap_lines(t: Tables) -> DataFrame:
    s = sap_silver(t)
    return sap.int_sap_sales_lines_enriched(s["items"], s["orders"], s["materials"], s["partners"], DEALS)


@query("stg_sap_material", f"WITH {base.STG_MATERIAL} SELECT * FROM stg_material")
def stg_sap_material(t: Tables) -> DataFrame:
    return sap.stg_sap_material(bronze.sap_material(t), None, RUN_TS)


@query("stg_sap_business_partner", f"WITH {base.STG_PARTNER} SELECT * FROM stg_partner")
def stg_sap_business_partner(t: Tables) -> DataFrame:
    return sap.stg_sap_business_partner(bronze.sap_business_partner(t), None, RUN_TS)


@query("stg_sap_sales_order", f"WITH {base.STG_SALES_ORDER} SELECT * FROM stg_sales_order")
def stg_sap_sales_order(t: Tables) -> DataFrame:
    return sap.stg_sap_sales_order(bronze.sap_sales_order(t), None, RUN_TS)


@query(
    "stg_sap_sales_order_item",
    f"""WITH {base.STG_ITEM} SELECT * REPLACE (CAST(order_quantity_mt AS DOUBLE) AS order_quantity_mt,
  CAST(net_value AS DOUBLE) AS net_value) FROM stg_item""",
)
def stg_sap_sales_order_item(t: Tables) -> DataFrame:
    return sap.stg_sap_sales_order_item(bronze.sap_sales_order_item(t), None, RUN_TS)


@query(
    "int_sap_sales_lines_enriched",
    f"WITH {base.LINES} SELECT {base.LINE_COLUMNS}, _airbyte_extracted_at FROM lines",
)
def int_sap_sales_lines_enriched(t: Tables) -> DataFrame:
    return sap_lines(t)


@query(
    "dim_sap_customer",
    f"""WITH {base.STG_PARTNER} SELECT partner_number, partner_name, country_code, region, industry_sector, customer_group,
  CAST(date_trunc('month', updated_at) AS DATE) AS partner_since_month, updated_at,
  _airbyte_extracted_at AS last_extracted_at, dbt_updated_at FROM stg_partner""",
)
def dim_sap_customer(t: Tables) -> DataFrame:
    return sap.dim_sap_customer(sap_silver(t)["partners"], None, RUN_TS)


# the stored dimension was built from the partners' first-order day; only recent partners are rebuilt
@query(
    "dim_sap_customer_incremental",
    f"""WITH {base.STG_PARTNER},
d AS (SELECT partner_number, partner_name, country_code, region, industry_sector, customer_group,
  CAST(date_trunc('month', updated_at) AS DATE) AS partner_since_month, updated_at,
  _airbyte_extracted_at AS last_extracted_at, dbt_updated_at FROM stg_partner),
bound AS (SELECT max(last_extracted_at) - INTERVAL 3 DAYS AS b FROM d WHERE last_extracted_at < TIMESTAMP '{CUT}')
SELECT d.* REPLACE (CASE WHEN last_extracted_at >= b THEN dbt_updated_at ELSE {EARLIER_TS} END AS dbt_updated_at)
FROM d, bound WHERE last_extracted_at IS NOT NULL""",
)
def dim_sap_customer_incremental(t: Tables) -> DataFrame:
    partners = sap_silver(t)["partners"]
    stored = sap.dim_sap_customer(before_cut(partners, names.EXTRACTED_AT), None, EARLIER_RUN)
    return sap.dim_sap_customer(partners, stored, RUN_TS)


@query(
    "dim_sap_material",
    f"""WITH {base.STG_MATERIAL} SELECT material_number, material_description, material_group, product_hierarchy, base_uom,
  plant_code, updated_at, _airbyte_extracted_at AS last_extracted_at, dbt_updated_at FROM stg_material""",
)
def dim_sap_material(t: Tables) -> DataFrame:
    return sap.dim_sap_material(sap_silver(t)["materials"], None, RUN_TS)


@query(
    "fct_sap_sales_lines",
    f"""WITH {base.LINES}
SELECT {base.LINE_COLUMNS}, _airbyte_extracted_at AS last_extracted_at, {TS} AS dbt_updated_at FROM lines""",
)
def fct_sap_sales_lines(t: Tables) -> DataFrame:
    return sap.fct_sap_sales_lines(sap_lines(t), None, RUN_TS)


@query(
    "mart_sap_chemical_sales_performance",
    f"""WITH {base.LINES}
SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_month, material_group, product_hierarchy, plant_code,
  sales_organization, country_code, customer_group, order_status, deal_size_segment, count(*) AS line_count,
  count(DISTINCT sales_order_number) AS order_count, count(DISTINCT partner_number) AS customer_count,
  CAST(sum(order_quantity_mt) AS DOUBLE) AS total_quantity_mt, CAST(sum(net_value) AS DOUBLE) AS total_net_value,
  {base.average("sum(unit_price_cents)", "count(unit_price_cents)")} AS avg_unit_price_per_mt, {TS} AS dbt_updated_at
FROM lines WHERE order_status <> 'CANCELLED' GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9""",
)
def mart_sap_chemical_sales_performance(t: Tables) -> DataFrame:
    return sap.mart_sap_chemical_sales_performance(sap.fct_sap_sales_lines(sap_lines(t), None, RUN_TS), RUN_TS)


# ---- countries


@query("stg_countries", f"WITH {base.STG_COUNTRIES} SELECT * FROM stg_countries")
def stg_countries(t: Tables) -> DataFrame:
    return countries.stg_countries(bronze.countries(t), RUN_TS)


@query(
    "dim_country",
    f"""WITH {base.STG_COUNTRIES} SELECT * RENAME (bronze_loaded_at AS last_loaded_at),
  (state_code = 0 AND status_code = 1) AS is_active FROM stg_countries""",
)
def dim_country(t: Tables) -> DataFrame:
    return countries.dim_country(countries.stg_countries(bronze.countries(t), RUN_TS), RUN_TS)
