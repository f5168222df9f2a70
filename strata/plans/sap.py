"""Chemical sales from ERP tables: materials, partners, orders and lines to monthly performance."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import columns as names
from strata.functions.numbers import money, segment, unit_price
from strata.functions.text import concat_key, norm
from strata.functions.time import as_instant, month_start, utc_literal
from strata.operators.aggregates import sums_and_distinct
from strata.operators.conform import conform, exclude_value, require_not_null, with_run_ts
from strata.operators.dedupe import latest_per_key
from strata.operators.incremental import LOOKBACK_DAYS, delete_insert, incremental_slice
from strata.operators.joins import enrich_lines
from strata.operators.prune import prune
from strata.operators.quality import Check, checks_for
from strata.plans.common import Report, count_late, finish, job, load, pass_gate, publish_all, require_fresh, together
from strata.plans.marts import changed_parts, month_of, refresh_parts
from strata.sources.landing import WATERMARKS, Sync
from strata.sources.publish import PublishSpec
from strata.sources.store import TableStore

BRONZE, SILVER, GOLD = "src_sap_chemicals", "silver_sap", "gold_sap"

# Deal size segments, from the highest minimum down.
DEAL_SEGMENTS = [(500_000, "large"), (100_000, "medium")]
LOWEST_DEAL = "standard"
CANCELLED = "CANCELLED"

MART_KEYS = [
    "order_month",
    "material_group",
    "product_hierarchy",
    "plant_code",
    "sales_organization",
    "country_code",
    "customer_group",
    "order_status",
    "deal_size_segment",
]

# How the sources are synced.
SYNCS = {
    "sap_material": Sync(("material_number",), "updated_at"),
    "sap_business_partner": Sync(("partner_number",), "updated_at"),
    "sap_sales_order": Sync(("sales_order_number",), "changed_at"),
    "sap_sales_order_item": Sync(("sales_order_number", "item_number"), "item_changed_at"),
}

# What is published of this pipeline, by which key, up to how many rows.
GOLD_STATISTICS = {
    "dim_sap_material": ["material_number"],
    "dim_sap_customer": ["partner_number"],
    "fct_sap_sales_lines": ["sales_order_item_key", "material_number", "partner_number"],
    "mart_sap_chemical_sales_performance": ["order_month", "material_group"],
}
PUBLICATIONS = [
    PublishSpec("mart_sap_chemical_sales_performance", tuple(MART_KEYS)),
    PublishSpec("dim_sap_material", ("material_number",)),
    PublishSpec("dim_sap_customer", ("partner_number",)),
    PublishSpec("fct_sap_sales_lines", ("sales_order_item_key",)),
]


#: How the latest row of each key is found: as ``latest_per_key``.
Rank = Callable[[DataFrame, list[str], list[str]], DataFrame]


def _silver_batch(
    bronze: DataFrame,
    target: DataFrame | None,
    run_ts: datetime,
    required: list[str],
    columns: dict[str, Column | tuple[str, str]],
    keys: list[str],
    changed_at: str,
    days: int,
    rank: Rank,
) -> DataFrame:
    rows = require_not_null(incremental_slice(bronze, target, names.EXTRACTED_AT, days=days), required)
    clean = conform(
        rows,
        {
            **columns,
            changed_at: as_instant(changed_at),
            names.EXTRACTED_AT: as_instant(names.EXTRACTED_AT),
        },
    )
    return with_run_ts(rank(clean, keys, [names.EXTRACTED_AT, changed_at]), run_ts)


def _silver(batch: DataFrame, target: DataFrame | None, key: str, bronze: DataFrame | None) -> DataFrame:
    if target is None:  # a fresh build holds only keys that the raw table has
        return batch
    merged = delete_insert(target, batch, [key], "sync_all")
    return merged if bronze is None else prune(merged, bronze, key)


def stg_sap_material_batch(bronze, target, run_ts, days: int = LOOKBACK_DAYS, rank: Rank = latest_per_key) -> DataFrame:
    columns = {
        "material_number": norm("material_number"),
        "material_description": norm("material_description"),
        "material_group": norm("material_group", "upper"),
        "product_hierarchy": norm("product_hierarchy"),
        "base_uom": norm("base_uom", "upper"),
        "plant_code": norm("plant_code", "upper"),
    }
    key = "material_number"
    return _silver_batch(bronze, target, run_ts, [key], columns, [key], "updated_at", days, rank)


def stg_sap_material(bronze, target, run_ts, days: int = LOOKBACK_DAYS) -> DataFrame:
    return _silver(stg_sap_material_batch(bronze, target, run_ts, days), target, "material_number", bronze)


def stg_sap_business_partner_batch(bronze, target, run_ts, days: int = LOOKBACK_DAYS, rank: Rank = latest_per_key) -> DataFrame:
    columns = {
        "partner_number": norm("partner_number"),
        "partner_name": norm("partner_name"),
        "country_code": norm("country_code", "upper"),
        "region": norm("region"),
        "industry_sector": norm("industry_sector"),
        "customer_group": norm("customer_group", "upper"),
    }
    key = "partner_number"
    return _silver_batch(bronze, target, run_ts, [key], columns, [key], "updated_at", days, rank)


def stg_sap_business_partner(bronze, target, run_ts, days: int = LOOKBACK_DAYS) -> DataFrame:
    batch = stg_sap_business_partner_batch(bronze, target, run_ts, days)
    return _silver(batch, target, "partner_number", bronze)


def stg_sap_sales_order_batch(bronze, target, run_ts, days: int = LOOKBACK_DAYS, rank: Rank = latest_per_key) -> DataFrame:
    columns = {
        "sales_order_number": norm("sales_order_number"),
        "partner_number": norm("partner_number"),
        "order_date": ("order_date", "date"),
        "requested_delivery_date": ("requested_delivery_date", "date"),
        "sales_organization": norm("sales_organization", "upper"),
        "distribution_channel": norm("distribution_channel"),
        "division": norm("division"),
        "currency_code": norm("currency_code", "upper"),
        "incoterms": norm("incoterms", "upper"),
        "order_status": norm("order_status", "upper"),
    }
    required = ["sales_order_number", "partner_number"]
    return _silver_batch(bronze, target, run_ts, required, columns, required[:1], "changed_at", days, rank)


def stg_sap_sales_order(bronze, target, run_ts, days: int = LOOKBACK_DAYS) -> DataFrame:
    return _silver(stg_sap_sales_order_batch(bronze, target, run_ts, days), target, "sales_order_number", bronze)


def stg_sap_sales_order_item_batch(bronze, target, run_ts, days: int = LOOKBACK_DAYS, rank: Rank = latest_per_key) -> DataFrame:
    columns = {
        "sales_order_item_key": concat_key([norm("sales_order_number"), norm("item_number")]),
        "sales_order_number": norm("sales_order_number"),
        "item_number": norm("item_number"),
        "material_number": norm("material_number"),
        "plant_code": norm("plant_code", "upper"),
        "order_quantity_mt": money("order_quantity", 13, 3),
        "net_value": money("net_value", 15, 2),
        "currency_code": norm("currency_code", "upper"),
    }
    required = ["sales_order_number", "item_number", "material_number"]
    key = ["sales_order_item_key"]
    return _silver_batch(bronze, target, run_ts, required, columns, key, "item_changed_at", days, rank)


def stg_sap_sales_order_item(bronze, target, run_ts, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Latest order lines. Lines deleted at the source stay: this table is not pruned."""
    batch = stg_sap_sales_order_item_batch(bronze, target, run_ts, days)
    return _silver(batch, target, "sales_order_item_key", None)


def int_sap_sales_lines_enriched(
    items: DataFrame,
    orders: DataFrame,
    materials: DataFrame,
    partners: DataFrame,
    segments: list[tuple[float, str]] = DEAL_SEGMENTS,
    lowest: str = LOWEST_DEAL,
) -> DataFrame:
    """Lines with header, material and partner attributes, unit price and deal size."""
    lines = items.select(
        "sales_order_item_key",
        "sales_order_number",
        "item_number",
        "material_number",
        "plant_code",
        "order_quantity_mt",
        "net_value",
        F.col("currency_code").alias("line_currency_code"),
        names.EXTRACTED_AT,
    )
    headers = orders.select(
        "sales_order_number",
        "partner_number",
        "order_date",
        "sales_organization",
        F.col("currency_code").alias("header_currency_code"),
        "incoterms",
        "order_status",
    )
    goods = materials.select("material_number", "material_description", "material_group", "product_hierarchy")
    buyers = partners.select("partner_number", "partner_name", "country_code", "customer_group", "industry_sector")
    return enrich_lines(lines, headers, goods, buyers).select(
        "sales_order_item_key",
        "sales_order_number",
        "item_number",
        "material_number",
        "material_description",
        "material_group",
        "product_hierarchy",
        "plant_code",
        "partner_number",
        "partner_name",
        "country_code",
        "customer_group",
        "industry_sector",
        "order_date",
        F.col("order_date").cast("date").alias("order_date_key"),
        "sales_organization",
        "header_currency_code",
        "line_currency_code",
        "incoterms",
        "order_status",
        "order_quantity_mt",
        "net_value",
        unit_price("net_value", "order_quantity_mt").alias("unit_price_per_mt"),
        segment("net_value", segments, lowest).alias("deal_size_segment"),
        names.EXTRACTED_AT,
    )


def dim_sap_customer_batch(partners, target, run_ts, days: int = LOOKBACK_DAYS) -> DataFrame:
    rows = incremental_slice(partners, target, names.EXTRACTED_AT, names.LAST_EXTRACTED_AT, days)
    return rows.select(
        "partner_number",
        "partner_name",
        "country_code",
        "region",
        "industry_sector",
        "customer_group",
        month_start("updated_at").alias("partner_since_month"),
        "updated_at",
        F.col(names.EXTRACTED_AT).alias(names.LAST_EXTRACTED_AT),
        utc_literal(run_ts).alias(names.BUILT_AT),
    )


def dim_sap_customer(partners, target, run_ts, days: int = LOOKBACK_DAYS) -> DataFrame:
    batch = dim_sap_customer_batch(partners, target, run_ts, days)
    return delete_insert(target, batch, ["partner_number"], "sync_all")


def dim_sap_material_batch(materials, target, run_ts, days: int = LOOKBACK_DAYS) -> DataFrame:
    rows = incremental_slice(materials, target, names.EXTRACTED_AT, names.LAST_EXTRACTED_AT, days)
    return rows.select(
        "material_number",
        "material_description",
        "material_group",
        "product_hierarchy",
        "base_uom",
        "plant_code",
        "updated_at",
        F.col(names.EXTRACTED_AT).alias(names.LAST_EXTRACTED_AT),
        utc_literal(run_ts).alias(names.BUILT_AT),
    )


def dim_sap_material(materials, target, run_ts, days: int = LOOKBACK_DAYS) -> DataFrame:
    batch = dim_sap_material_batch(materials, target, run_ts, days)
    return delete_insert(target, batch, ["material_number"], "sync_all")


def fct_sap_sales_lines_batch(lines, target, run_ts, days: int = LOOKBACK_DAYS) -> DataFrame:
    rows = incremental_slice(lines, target, "order_date", days=days)
    return rows.withColumnRenamed(names.EXTRACTED_AT, names.LAST_EXTRACTED_AT).withColumn(
        names.BUILT_AT, utc_literal(run_ts)
    )


def fct_sap_sales_lines(lines, target, run_ts, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Line fact; not pruned."""
    batch = fct_sap_sales_lines_batch(lines, target, run_ts, days)
    return delete_insert(target, batch, ["sales_order_item_key"], "sync_all")


def mart_sap_chemical_sales_performance(fct: DataFrame, run_ts: datetime, stored: bool = False) -> DataFrame:
    """Monthly quantities and values without cancelled orders (and without orders of unknown status). A ``stored`` fact is read more
    than once and shuffled less."""
    lines = exclude_value(fct, "order_status", CANCELLED).withColumn("order_month", month_start("order_date"))
    price = F.col("unit_price_per_mt")
    totals = sums_and_distinct(
        lines,
        MART_KEYS,
        {
            "line_count": F.lit(1),
            "total_quantity_mt": F.col("order_quantity_mt"),
            "total_net_value": F.col("net_value"),
            "price_sum": price,
            "price_count": price.isNotNull().cast("int"),
        },
        {"order_count": "sales_order_number", "customer_count": "partner_number"},
        stored,
    )
    average = F.when(F.col("price_count") > 0, F.col("price_sum") / F.col("price_count"))
    return totals.select(
        *MART_KEYS,
        "line_count",
        "order_count",
        "customer_count",
        F.col("total_quantity_mt").cast("decimal(23,3)").alias("total_quantity_mt"),
        F.col("total_net_value").cast("decimal(25,2)").alias("total_net_value"),
        average.cast("decimal(23,6)").alias("avg_unit_price_per_mt"),
        utc_literal(run_ts).alias(names.BUILT_AT),
    )


FACT, MART = f"{GOLD}/fct_sap_sales_lines", f"{GOLD}/mart_sap_chemical_sales_performance"


def refresh_mart(store: TableStore, run_ts: datetime, whole: bool = False) -> DataFrame:
    """Bring the stored mart up to date by building the months anew in which the fact changed.

    Distinct orders and customers are counted within a month, so a month is all that its rows need.
    """
    months = changed_parts(store, FACT, [MART], whole)
    keys = ["order_month", "material_group"]
    mart = refresh_parts(store, FACT, MART, lambda lines: mart_sap_chemical_sales_performance(lines, run_ts, stored=True), month_of("order_month"), keys, months)
    store.settle(FACT)
    return mart


def silver_checks(bronze: dict[str, DataFrame], silver: dict[str, DataFrame], lines: DataFrame) -> list[Check]:
    def keyed(table: str, df: DataFrame, key: str) -> list[Check]:
        return checks_for(table, df, not_null=[key], unique=[key])

    return [
        *checks_for(
            "source_sap_material",
            bronze["sap_material"],
            not_null=["material_number", "updated_at"],
            unique=["material_number"],
        ),
        *checks_for(
            "source_sap_business_partner",
            bronze["sap_business_partner"],
            not_null=["partner_number", "updated_at"],
            unique=["partner_number"],
        ),
        *checks_for(
            "source_sap_sales_order",
            bronze["sap_sales_order"],
            not_null=["sales_order_number", "partner_number", "changed_at"],
            unique=["sales_order_number"],
            relationships={"partner_number": (bronze["sap_business_partner"], "partner_number")},
        ),
        *checks_for(
            "source_sap_sales_order_item",
            bronze["sap_sales_order_item"],
            not_null=["sales_order_number", "item_number", "material_number", "item_changed_at"],
            relationships={"material_number": (bronze["sap_material"], "material_number")},
        ),
        *keyed("stg_sap_material", silver["stg_sap_material"], "material_number"),
        *keyed("stg_sap_business_partner", silver["stg_sap_business_partner"], "partner_number"),
        *keyed("stg_sap_sales_order", silver["stg_sap_sales_order"], "sales_order_number"),
        *keyed("stg_sap_sales_order_item", silver["stg_sap_sales_order_item"], "sales_order_item_key"),
        *keyed("int_sap_sales_lines_enriched", lines, "sales_order_item_key"),
    ]


def gold_checks(gold: dict[str, DataFrame]) -> list[Check]:
    checks = []
    for table, key in [
        ("dim_sap_material", "material_number"),
        ("dim_sap_customer", "partner_number"),
        ("fct_sap_sales_lines", "sales_order_item_key"),
    ]:
        checks += checks_for(table, gold[table], not_null=[key], unique=[key])
    mart = "mart_sap_chemical_sales_performance"
    return checks + checks_for(mart, gold[mart], not_null=["order_month", "material_group", "total_net_value"])


@job
def run_sap(
    bronze: dict[str, DataFrame],
    store: TableStore,
    run_ts: datetime,
    watermarks: DataFrame | None = None,
    full_refresh: bool = False,
    days: int = LOOKBACK_DAYS,
    publications: list[PublishSpec] = PUBLICATIONS,
    keep_failures: bool = True,
    line_buckets: int = 64,
    master_buckets: int = 16,
    load_sources: bool = False,
    catalog: bool = False,
) -> Report:
    """Load, freshness, Silver, Silver gate, Gold, Gold gate, publish, finish.

    ``bronze``: frames ``sap_material``, ``sap_business_partner``, ``sap_sales_order`` and
    ``sap_sales_order_item``; with ``load_sources`` they are the sources, which the run lands first. Silver lines, which
    carry no date, and master data are stored by key bucket; the counts should make a bucket the size of a file.
    """
    report = Report()
    if load_sources:
        bronze = load(store, BRONZE, bronze, SYNCS, run_ts, report)
        watermarks = store.read(WATERMARKS)
    require_fresh(watermarks, BRONZE, run_ts, report)

    def write(layer, table, batch_of, source, key, buckets, alive):
        name = f"{layer}/{table}"
        target = None if full_refresh else store.read_or_none(name)
        batch = batch_of(source, target, run_ts, days)
        part = None if buckets else month
        if full_refresh:
            return store.overwrite(name, batch, [key], part, buckets=buckets, dealt=True)
        upstream = (alive, key) if alive is not None else None
        return store.merge(name, batch, [key], part, "sync_all", upstream, buckets, log=name == FACT, dealt=True)

    raw = bronze
    month = F.date_format("order_date", "yyyy-MM")
    plan = [
        ("sap_material", stg_sap_material_batch, "material_number", master_buckets, True),
        ("sap_business_partner", stg_sap_business_partner_batch, "partner_number", master_buckets, True),
        ("sap_sales_order", stg_sap_sales_order_batch, "sales_order_number", None, True),
        ("sap_sales_order_item", stg_sap_sales_order_item_batch, "sales_order_item_key", line_buckets, False),
    ]
    steps = [
        partial(write, SILVER, f"stg_{t}", partial(batch_of, rank=partial(store.latest, f"{SILVER}/stg_{t}")), raw[t], key, buckets, raw[t] if pruned else None)
        for t, batch_of, key, buckets, pruned in plan
    ]
    silver = dict(zip([f"stg_{p[0]}" for p in plan], together(store.spark, steps), strict=True))
    report.stages.append("silver")
    lines = int_sap_sales_lines_enriched(
        silver["stg_sap_sales_order_item"],
        silver["stg_sap_sales_order"],
        silver["stg_sap_material"],
        silver["stg_sap_business_partner"],
    )
    # read by two checks, the late rows and the fact
    lines = store.stage(f"{SILVER}/int_sap_sales_lines_enriched", lines)
    pass_gate("silver gate", silver_checks(bronze, silver, lines), report, store, run_ts, keep_failures)

    if not full_refresh:
        seen = lines.select("sales_order_item_key", "order_date", "order_status", "net_value", "order_quantity_mt", names.EXTRACTED_AT)
        count_late(report, store, FACT, seen, ["sales_order_item_key"], "order_date", month, days)
    partners, materials = silver["stg_sap_business_partner"], silver["stg_sap_material"]
    tables = [
        ("dim_sap_material", dim_sap_material_batch, materials, "material_number", master_buckets),
        ("dim_sap_customer", dim_sap_customer_batch, partners, "partner_number", master_buckets),
        ("fct_sap_sales_lines", fct_sap_sales_lines_batch, lines, "sales_order_item_key", None),
    ]
    built = together(store.spark, [partial(write, GOLD, *table, None) for table in tables])
    gold = dict(zip([t[0] for t in tables], built, strict=True))
    mart = "mart_sap_chemical_sales_performance"
    gold[mart] = refresh_mart(store, run_ts, full_refresh)
    report.stages.append("gold")
    pass_gate("gold gate", gold_checks(gold), report, store, run_ts, keep_failures)
    publish_all(store, GOLD, publications, report)
    statistics = {f"{GOLD}/{t}": columns for t, columns in GOLD_STATISTICS.items()}
    finish(store, report, statistics if catalog else None)
    return report
