"""Synthetic source data of any size, for performance demos and drills.

Values are a hash of (row id, seed, column), not of a per-partition random stream: the data does not
depend on the number of partitions, and a task that is run again makes the same rows.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.time import utc_literal

# Shapes of the sample data.
CUSTOMERS = 20
ORDERS_PER_CUSTOMER = 50
ORDER_DAYS = 365
PARTNERS = 12
ORDERS_PER_PARTNER = 18
MATERIALS = 12
INCOTERMS = ["FOB", "CIF", "DDP", "EXW"]
MATERIAL_GROUPS = ["INTERMEDIATE", "POLYOLEFIN", "FERTILIZER", "SPECIALTY", "PETROCHEM", "POLYMER", "INORGANIC"]
CUSTOMER_GROUPS = ["KEY_ACCOUNT", "STRATEGIC", "EXPORT", "DOMESTIC", "INTERCO"]
COUNTRIES = ["TH", "SG", "MY", "TW"]


def uniform(row: Column | str, seed: int, stream: str) -> Column:
    """A repeatable uniform number in [0, 1) for a row id."""
    row = F.col(row) if isinstance(row, str) else row
    return F.pmod(F.xxhash64(row, F.lit(seed), F.lit(stream)), F.lit(1 << 52)) / F.lit(float(1 << 52))


def pick(values: list[str], u: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.floor(u * len(values)).cast("int") + 1)


def gen_customers(spark: SparkSession, n: int, as_of: datetime) -> DataFrame:
    return spark.range(1, n + 1).select(
        F.col("id").cast("int").alias("id"),
        F.concat(F.lit("Customer "), "id").alias("name"),
        F.concat(F.lit("customer."), "id", F.lit("@example.com")).alias("email"),
        (utc_literal(as_of) - F.make_dt_interval(days=F.pmod("id", F.lit(30)).cast("int") + 1)).alias("created_at"),
    )


def _order_columns(seed: int) -> list[Column]:
    return [
        F.round(uniform("id", seed, "amount") * 500 + 10, 2).cast("decimal(10,2)").alias("amount"),
        F.when(uniform("id", seed, "status") < 0.05, "cancelled").otherwise("completed").alias("status"),
    ]


def gen_orders(
    spark: SparkSession, n: int, seed: int, as_of: datetime, customers: int = CUSTOMERS, days: int = ORDER_DAYS
) -> DataFrame:
    """n orders spread over the customers and the last ``days`` days."""
    amount, status = _order_columns(seed)
    back = F.floor(uniform("id", seed, "day") * days).cast("int")
    return spark.range(1, n + 1).select(
        F.col("id"),
        (F.floor(uniform("id", seed, "customer") * customers) + 1).cast("int").alias("customer_id"),
        amount,
        (utc_literal(as_of) - F.make_dt_interval(days=back)).alias("order_date"),
        status,
    )


def gen_customer_orders(customers: DataFrame, per_customer: int, seed: int, as_of: datetime) -> DataFrame:
    """``per_customer`` orders for each customer, one per day going back."""
    numbered = customers.select(
        F.col("id").alias("customer_id"), F.explode(F.sequence(F.lit(1), F.lit(per_customer))).alias("n")
    ).withColumn("id", F.col("customer_id").cast("bigint") * per_customer + F.col("n"))
    amount, status = _order_columns(seed)
    return numbered.select(
        "id", "customer_id", amount, (utc_literal(as_of) - F.make_dt_interval(days=F.col("n"))).alias("order_date"), status
    )


def gen_sap(
    spark: SparkSession,
    seed: int,
    as_of: date,
    partners: int = PARTNERS,
    orders_per: int = ORDERS_PER_PARTNER,
    materials: int = MATERIALS,
) -> dict[str, DataFrame]:
    """Materials, partners, orders (``orders_per`` each) and one to three lines per order."""
    now = utc_literal(datetime.combine(as_of, datetime.min.time()))

    def days_ago(n: Column) -> Column:
        return now - F.make_dt_interval(days=n.cast("int"))

    material_no = F.concat(F.lit("MAT-"), F.lpad(F.col("id").cast("string"), 8, "0"))
    plant = F.when(uniform("id", seed, "plant") < 0.85, "TH01").otherwise("JP01")
    material = spark.range(1, materials + 1).select(
        material_no.alias("material_number"),
        F.concat(F.lit("Material "), "id").alias("material_description"),
        pick(MATERIAL_GROUPS, uniform("id", seed, "group")).alias("material_group"),
        F.concat(F.lit("H/"), F.pmod("id", F.lit(10))).alias("product_hierarchy"),
        F.lit("MT").alias("base_uom"),
        plant.alias("plant_code"),
        days_ago(F.lit(91) - F.pmod("id", F.lit(13))).alias("updated_at"),
    )
    partner_no = F.lpad((F.col("id") + 1_000_001_000).cast("string"), 10, "0")
    country = pick(COUNTRIES, uniform("id", seed, "country"))
    partner = spark.range(1, partners + 1).select(
        partner_no.alias("partner_number"),
        F.concat(F.lit("Partner "), "id").alias("partner_name"),
        country.alias("country_code"),
        F.concat(F.lit("Region "), F.pmod("id", F.lit(5))).alias("region"),
        F.concat(F.lit("Sector "), F.pmod("id", F.lit(7))).alias("industry_sector"),
        pick(CUSTOMER_GROUPS, uniform("id", seed, "customer group")).alias("customer_group"),
        days_ago(F.lit(121) - F.pmod("id", F.lit(30))).alias("updated_at"),
    )
    # order n belongs to partner (n - 1) / orders_per + 1
    owner = F.floor((F.col("id") - 1) / orders_per) + 1
    n = F.col("id")
    base = spark.range(1, partners * orders_per + 1)
    order_no = F.concat(F.lit("45"), F.lpad((n + 1_000_000).cast("string"), 8, "0"))
    changed = days_ago(F.pmod(n, F.lit(90)))
    currency = F.when(uniform(n, seed, "currency") < 0.25, "USD").otherwise("THB")
    owner_country = pick(COUNTRIES, uniform(owner, seed, "country"))
    today = F.lit(as_of)
    order = base.select(
        order_no.alias("sales_order_number"),
        F.lpad((owner + 1_000_001_000).cast("string"), 10, "0").alias("partner_number"),
        F.date_sub(today, (F.pmod(n, F.lit(180)) + 1).cast("int")).alias("order_date"),
        F.date_add(F.date_sub(today, F.pmod(n, F.lit(180)).cast("int")), 14).alias("requested_delivery_date"),
        F.when(owner_country == "TH", "TH01").otherwise("SG01").alias("sales_organization"),
        F.lit("10").alias("distribution_channel"),
        F.lit("01").alias("division"),
        currency.alias("currency_code"),
        pick(INCOTERMS, uniform(n, seed, "incoterms")).alias("incoterms"),
        F.when(uniform(n, seed, "status") < 0.04, "CANCELLED").otherwise("COMPLETED").alias("order_status"),
        changed.alias("changed_at"),
    )
    lines = (F.floor(uniform("id", seed, "lines") * 3) + 1).cast("int")
    line = base.withColumn("j", F.explode(F.sequence(F.lit(1), lines))).withColumn("line_id", n * 10 + F.col("j"))
    quantity = F.round(uniform("line_id", seed, "quantity") * 95 + 5, 3).cast("decimal(13,3)")
    price = F.round(uniform("line_id", seed, "price") * 4200 + 800, 2).cast("decimal(10,2)")
    picked = F.floor(uniform("line_id", seed, "material") * materials) + 1
    item = line.select(
        order_no.alias("sales_order_number"),
        F.lpad((F.col("j") * 10).cast("string"), 6, "0").alias("item_number"),
        F.concat(F.lit("MAT-"), F.lpad(picked.cast("string"), 8, "0")).alias("material_number"),
        F.when(uniform("line_id", seed, "plant") < 0.85, "TH01").otherwise("JP01").alias("plant_code"),
        quantity.alias("order_quantity"),
        F.round(quantity * price, 2).cast("decimal(15,2)").alias("net_value"),
        currency.alias("currency_code"),
        (changed + F.make_dt_interval(mins=F.col("j"))).alias("item_changed_at"),
    )
    return {
        "sap_material": material,
        "sap_business_partner": partner,
        "sap_sales_order": order,
        "sap_sales_order_item": item,
    }


# The rows of the bad-data drill.
DRILL_FLOOR = 900_000_000
DRILL_STATUS = "BAD_DATA_DRILL"


def drill_orphan_order(spark: SparkSession, as_of: datetime) -> DataFrame:
    """An order of a customer that does not exist."""
    return spark.createDataFrame(
        [(900000001, 999999999, "123.45", as_of, "BAD_DATA_DRILL_ORPHAN")],
        "id bigint, customer_id bigint, amount string, order_date timestamp_ntz, status string",
    ).withColumn("amount", F.col("amount").cast("decimal(10,2)"))


def drill_duplicate_email(spark: SparkSession, email: str, as_of: datetime) -> DataFrame:
    """A customer reusing somebody's email."""
    return spark.createDataFrame(
        [(900000002, "Bad Drill Duplicate", email, as_of)],
        "id bigint, name string, email string, created_at timestamp_ntz",
    )


def is_drill_row(id_col: str = "id", status_col: str | None = None) -> Column:
    """The condition that finds drill rows again, for ``delete_where``."""
    found = F.col(id_col) >= DRILL_FLOOR
    return found | F.col(status_col).like(f"{DRILL_STATUS}%") if status_col else found


