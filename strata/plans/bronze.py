"""The test tables seen as the raw tables of the three pipelines.

Stand-ins, because the test tables lack the columns: a customer was created with its first order and
last extracted with its last one; an order or line was extracted on its own date; API country records
are customers whose "code" is nation plus market segment, so that codes repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import columns as names
from strata.functions.numbers import money


class Tables:
    """The parquet tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        # kept as an attribute, so that a table's footers are read once per query
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, df)
        return df


def activity(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order")
    )


def customers(t: Tables) -> DataFrame:
    c = t.customer.join(activity(t), F.col("c_custkey") == F.col("o_custkey"), "left")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("  "), F.upper("c_name"), F.lit("@example.com ")).alias("email"),
        F.col("first_order").alias("created_at"),
        F.col("last_order").alias(names.EXTRACTED_AT),
    )


def orders(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        money("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias(names.EXTRACTED_AT),
    )


def sap_material(t: Tables) -> DataFrame:
    stamp = F.lit("1995-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=F.col("p_size"))
    return t.part.select(
        F.col("p_partkey").cast("string").alias("material_number"),
        F.col("p_name").alias("material_description"),
        F.lower("p_type").alias("material_group"),
        F.col("p_brand").alias("product_hierarchy"),
        F.lit("mt").alias("base_uom"),
        F.concat(F.lit("p"), "p_size").alias("plant_code"),
        stamp.alias("updated_at"),
        stamp.alias(names.EXTRACTED_AT),
    )


def sap_business_partner(t: Tables) -> DataFrame:
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(activity(t), F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            F.col("c_custkey").cast("string").alias("partner_number"),
            F.col("c_name").alias("partner_name"),
            F.lower("n_name").alias("country_code"),
            F.col("r_name").alias("region"),
            F.col("c_mktsegment").alias("industry_sector"),
            F.lower("c_mktsegment").alias("customer_group"),
            F.col("first_order").alias("updated_at"),
            F.col("last_order").alias(names.EXTRACTED_AT),
        )
    )


def sap_sales_order(t: Tables) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "P", "cancelled").when(F.col("o_orderstatus") == "F", "completed")
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("sales_order_number"),
        F.col("o_custkey").cast("string").alias("partner_number"),
        F.col("o_orderdate").alias("order_date"),
        F.date_add(F.col("o_orderdate").cast("date"), 14).alias("requested_delivery_date"),
        F.lower("o_orderpriority").alias("sales_organization"),
        F.lit("10").alias("distribution_channel"),
        F.lit("01").alias("division"),
        F.lit("thb").alias("currency_code"),
        F.substring("o_orderpriority", 3, 3).alias("incoterms"),
        status.otherwise("open").alias("order_status"),
        F.col("o_orderdate").alias("changed_at"),
        F.col("o_orderdate").alias(names.EXTRACTED_AT),
    )


def sap_sales_order_item(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("sales_order_number"),
        F.lpad((F.col("l_linenumber") * 10).cast("string"), 6, "0").alias("item_number"),
        F.col("l_partkey").cast("string").alias("material_number"),
        F.lower("l_returnflag").alias("plant_code"),
        F.col("l_quantity").alias("order_quantity"),
        F.col("l_extendedprice").alias("net_value"),
        F.lit("thb").alias("currency_code"),
        F.col("l_shipdate").alias("item_changed_at"),
        F.col("l_shipdate").alias(names.EXTRACTED_AT),
    )


def countries(t: Tables) -> DataFrame:
    balance = F.col("c_acctbal")
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(activity(t), F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            F.concat(F.lit(" "), F.col("c_custkey").cast("string")).alias("countryid"),
            F.concat(F.lower("n_name"), F.lit("-"), F.lower("c_mktsegment"), F.lit(" ")).alias("countrycode"),
            F.rpad("c_name", (F.floor(balance / 1000) + 19).cast("int"), "x").alias("country"),
            F.when(balance < 0, "  ").otherwise(F.floor(balance).cast("string")).alias("importsequencenumber"),
            F.when(balance < 1000, "1").when(balance < 9000, "0").otherwise("").alias("statecode"),
            F.when(balance < 5000, "1").otherwise(" 2").alias("statuscode"),
            F.col("last_order").alias(names.EXTRACTED_AT),
        )
    )
