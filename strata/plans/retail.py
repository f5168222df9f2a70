"""Retail sales: customers and orders from raw tables to monthly performance.

Each model takes frames and returns a frame. ``target`` is the stored table of an earlier run; without
it a model is built in full. ``*_batch`` gives the rows an incremental run would write.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import columns as names
from strata.functions.numbers import money, segment
from strata.functions.text import norm
from strata.functions.time import INSTANT, as_instant, month_start, utc_literal
from strata.operators import calendar
from strata.operators.conform import conform, require_not_null, with_run_ts
from strata.operators.contract import enforce_contract
from strata.operators.dedupe import latest_per_key
from strata.operators.history import scd2_apply, scd2_start
from strata.operators.incremental import LOOKBACK_DAYS, delete_insert, incremental_slice
from strata.operators.joins import drop_keys, keep_keys, orphans
from strata.operators.prune import absent_rows, prune
from strata.operators.quality import Check, checks_for
from strata.plans.common import Report, count_late, finish, job, load, pass_gate, publish_all, require_fresh, together
from strata.plans.marts import changed_parts, month_of, parts_holding, refresh_parts
from strata.sources.landing import WATERMARKS, Sync
from strata.sources.publish import PublishSpec
from strata.sources.store import TableStore

BRONZE, SILVER, GOLD = "src_local_postgres", "silver_sales", "gold_sales"

# Order value segments, from the highest minimum down.
VALUE_SEGMENTS = [(1000, "high"), (100, "medium")]
LOWEST_SEGMENT = "low"

MART_KEYS = [
    "order_month",
    "customer_id",
    "customer_name",
    "customer_cohort_month",
    "order_status",
    "order_value_segment",
]

FCT_ORDERS_CONTRACT = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("order_date", T.TimestampNTZType()),
        T.StructField("order_date_key", T.DateType()),
        T.StructField("order_amount", T.DecimalType(18, 2)),
        T.StructField("order_status", T.StringType()),
        T.StructField("order_value_segment", T.StringType()),
        T.StructField(names.LAST_EXTRACTED_AT, T.TimestampNTZType()),
        T.StructField(names.BUILT_AT, T.TimestampNTZType()),
    ]
)

# How the sources are synced.
SYNCS = {"customers": Sync(("id",), "created_at"), "orders": Sync(("id",), "order_date")}

# The Gold tables, and the columns whose statistics the optimizer wants. What is published, by which key.
GOLD_STATISTICS = {
    "dim_customer": ["customer_id"],
    "dim_date": ["date_key"],
    "fct_orders": ["order_id", "customer_id", "order_date_key"],
    "mart_sales_performance": ["customer_id", "order_month"],
}
PUBLICATIONS = [
    PublishSpec("mart_sales_performance", ("customer_id", "order_month", "order_status", "order_value_segment")),
    PublishSpec("dim_customer", ("customer_id",)),
    PublishSpec("dim_date", ("date_key",)),
    PublishSpec("fct_orders", ("order_id",)),
]


def stg_customers_batch(
    bronze: DataFrame, target: DataFrame | None, run_ts: datetime, days: int = LOOKBACK_DAYS
) -> DataFrame:
    rows = require_not_null(incremental_slice(bronze, target, names.EXTRACTED_AT, days=days), ["id"])
    clean = conform(
        rows,
        {
            "customer_id": ("id", "bigint"),
            "customer_name": norm("name"),
            "email": norm("email", "lower"),
            "created_at": as_instant("created_at"),
            names.EXTRACTED_AT: as_instant(names.EXTRACTED_AT),
        },
    )
    return with_run_ts(latest_per_key(clean, ["customer_id"], [names.EXTRACTED_AT, "created_at"]), run_ts)


def stg_customers(
    bronze: DataFrame, target: DataFrame | None, run_ts: datetime, days: int = LOOKBACK_DAYS
) -> DataFrame:
    """Latest state of every customer still in the raw table."""
    batch = stg_customers_batch(bronze, target, run_ts, days)
    if target is None:  # a fresh build holds only keys that the raw table has
        return batch
    return prune(delete_insert(target, batch, ["customer_id"], "sync_all"), bronze, "customer_id", "id")


def stg_orders_batch(
    bronze: DataFrame, target: DataFrame | None, run_ts: datetime, days: int = LOOKBACK_DAYS
) -> DataFrame:
    rows = incremental_slice(bronze, target, names.EXTRACTED_AT, days=days)
    clean = conform(
        require_not_null(rows, ["id", "customer_id"]),
        {
            "order_id": ("id", "bigint"),
            "customer_id": ("customer_id", "bigint"),
            "order_date": as_instant("order_date"),
            "order_amount": money("amount"),
            "order_status": norm("status", "lower"),
            names.EXTRACTED_AT: as_instant(names.EXTRACTED_AT),
        },
    )
    return with_run_ts(latest_per_key(clean, ["order_id"], [names.EXTRACTED_AT, "order_date"]), run_ts)


def stg_orders(
    bronze: DataFrame, target: DataFrame | None, run_ts: datetime, days: int = LOOKBACK_DAYS
) -> DataFrame:
    """Latest state of every order still in the raw table."""
    batch = stg_orders_batch(bronze, target, run_ts, days)
    if target is None:
        return batch
    return prune(delete_insert(target, batch, ["order_id"], "sync_all"), bronze, "order_id", "id")


def int_orders_enriched(
    orders: DataFrame, segments: list[tuple[float, str]] = VALUE_SEGMENTS, lowest: str = LOWEST_SEGMENT
) -> DataFrame:
    """Orders with their calendar day and value segment."""
    return orders.select(
        "order_id",
        "customer_id",
        "order_date",
        F.col("order_date").cast("date").alias("order_date_key"),
        "order_amount",
        "order_status",
        segment("order_amount", segments, lowest).alias("order_value_segment"),
        names.EXTRACTED_AT,
    )


def dim_customer_batch(
    customers: DataFrame, target: DataFrame | None, run_ts: datetime, days: int = LOOKBACK_DAYS
) -> DataFrame:
    # the slice compares a row's extraction time with the dimension's build time
    rows = incremental_slice(customers, target, names.EXTRACTED_AT, names.BUILT_AT, days)
    return rows.select(
        "customer_id",
        "customer_name",
        "email",
        F.col("created_at").alias("customer_created_at"),
        month_start("created_at", INSTANT).alias("customer_cohort_month"),
        utc_literal(run_ts).alias(names.BUILT_AT),
    )


def dim_customer(
    customers: DataFrame, target: DataFrame | None, run_ts: datetime, days: int = LOOKBACK_DAYS
) -> DataFrame:
    batch = dim_customer_batch(customers, target, run_ts, days)
    if target is None:
        return batch
    return prune(delete_insert(target, batch, ["customer_id"], "sync_all"), customers, "customer_id")


def dim_date(orders_enriched: DataFrame, run_ts: datetime) -> DataFrame:
    return calendar.dim_date(orders_enriched, "order_date_key", run_ts)


def fct_orders_batch(
    orders_enriched: DataFrame, target: DataFrame | None, run_ts: datetime, days: int = LOOKBACK_DAYS
) -> DataFrame:
    rows = incremental_slice(orders_enriched, target, "order_date", days=days)
    fact = rows.withColumnRenamed(names.EXTRACTED_AT, names.LAST_EXTRACTED_AT)
    return enforce_contract(fact.withColumn(names.BUILT_AT, utc_literal(run_ts)), FCT_ORDERS_CONTRACT)


def fct_orders(
    orders_enriched: DataFrame,
    target: DataFrame | None,
    run_ts: datetime,
    silver_orders: DataFrame | None = None,
    days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """Order fact. Changes to orders older than the lookback wait for a full refresh, yet orders gone
    from Silver leave the fact at once."""
    batch = fct_orders_batch(orders_enriched, target, run_ts, days)
    if target is None:
        return batch
    merged = delete_insert(target, batch, ["order_id"], "append_new")
    return prune(merged, silver_orders if silver_orders is not None else orders_enriched, "order_id")


def mart_sales_performance(fct: DataFrame, customers: DataFrame, run_ts: datetime) -> DataFrame:
    """Monthly sales per customer, status and segment. Orders without a customer are left out.

    Orders are aggregated per customer before they meet the dimension: the join then moves one row per
    customer, month, status and segment instead of every order, and a customer with a third of all
    orders is folded on the map side. The second aggregate keeps the result exact should the dimension
    repeat a customer.
    """
    return named_sales(folded_sales(fct), customers, run_ts)


def folded_sales(fct: DataFrame) -> DataFrame:
    """The sums behind the mart, per customer without the customer's attributes."""
    return fct.groupBy(
        month_start("order_date", INSTANT).alias("order_month"), "customer_id", "order_status", "order_value_segment"
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("order_amount").alias("s"),
        F.count("order_amount").alias("n_amount"),
        F.min("order_amount").alias("lo"),
        F.max("order_amount").alias("hi"),
    )


def named_sales(folded: DataFrame, customers: DataFrame, run_ts: datetime) -> DataFrame:
    """The mart of folded sales."""
    named = folded.join(
        customers.select("customer_id", "customer_name", "customer_cohort_month"), "customer_id"
    )
    total = F.sum("s").cast("decimal(28,2)")
    return named.groupBy(*MART_KEYS).agg(
        F.sum("n").alias("order_count"),
        total.alias("total_revenue"),
        F.when(F.sum("n_amount") > 0, total / F.sum("n_amount")).cast("decimal(22,6)").alias("avg_order_value"),
        F.min("lo").alias("min_order_value"),
        F.max("hi").alias("max_order_value"),
        utc_literal(run_ts).alias(names.BUILT_AT),
    )


MART, MART_STATE = f"{GOLD}/mart_sales_performance", f"{GOLD}/mart_sales_state"


def renamed_customers(batch: DataFrame, stored: DataFrame | None, customers: DataFrame) -> DataFrame | None:
    """Ids of customers whose attributes in the mart change with the dimension's batch, or who leave."""
    if stored is None:
        return None
    shown = ["customer_id", "customer_name", "customer_cohort_month"]
    changed = drop_keys(batch.select(shown), stored, shown, nulls_match=True).select("customer_id")
    return changed.union(absent_rows(stored.select("customer_id"), customers, "customer_id", "customer_id")).distinct()


def refresh_mart(store: TableStore, customers: DataFrame, run_ts: datetime, whole: bool = False) -> DataFrame:
    """Bring the stored mart up to date: months in which the fact changed are folded anew, and months with sales of customers
    whose attributes changed are put together again from the stored sums."""
    fact, renamed = f"{GOLD}/fct_orders", store.changes(f"{MART}/customers")
    months, month = changed_parts(store, fact, [MART_STATE, MART], whole), month_of("order_month")
    refresh_parts(store, fact, MART_STATE, folded_sales, month, ["customer_id"], months)
    if months is not None and renamed is not None:
        months = sorted({*months, *parts_holding(store, MART_STATE, month, lambda sums: keep_keys(sums, renamed, "customer_id"))})
    keys = ["customer_id", "order_month"]
    mart = refresh_parts(store, MART_STATE, MART, lambda sums: named_sales(sums, customers, run_ts), month, keys, months)
    store.settle(fact, f"{MART}/customers")
    return mart


SNAPSHOT_COLUMNS = ["customer_id", "customer_name", "email", "created_at", names.EXTRACTED_AT]


def snap_stg_customers(history: DataFrame | None, customers: DataFrame, run_ts: datetime) -> DataFrame:
    """Type-2 history of the customers, keys that left the source closed at ``run_ts``."""
    current = customers.select(*SNAPSHOT_COLUMNS)
    return scd2_apply(history, current, "customer_id", names.EXTRACTED_AT, run_ts)


def store_snapshot(store: TableStore, table: str, customers: DataFrame, run_ts: datetime) -> DataFrame:
    """The same on a stored history. Only open versions, and those closed in the same months as the ones this run
    closes, are read and rewritten."""
    current = customers.select(*SNAPSHOT_COLUMNS)
    part = F.coalesce(F.concat(F.lit("closed-"), F.date_format(names.SCD_VALID_TO, "yyyy-MM")), F.lit("open"))
    if store.exists(table):
        opened = store.read(table, parts=["open"])
        rows = store.stage(f"{table}/rows", scd2_apply(opened, current, "customer_id", names.EXTRACTED_AT, run_ts))
        months = {r[0] for r in rows.select(part).distinct().collect()} - {"open"}
        rows = rows.unionByName(store.read(table, parts=sorted(months)))
    else:
        rows = scd2_start(current, "customer_id", names.EXTRACTED_AT)
    return store.replace_parts(table, rows, part, gone=["open"], keys=["customer_id"])


def silver_checks(bronze: dict[str, DataFrame], customers: DataFrame, orders: DataFrame) -> list[Check]:
    raw_customers, raw_orders = bronze["customers"], bronze["orders"]
    enriched = int_orders_enriched(orders)
    return [
        *checks_for("source_customers", raw_customers, not_null=["id", "name", "email", "created_at"]),
        *checks_for(
            "source_orders",
            raw_orders,
            not_null=["id", "customer_id", "order_date", "amount"],
            relationships={"customer_id": (raw_customers, "id")},
        ),
        *checks_for(
            "stg_customers", customers, not_null=["customer_id", "email"], unique=["customer_id", "email"]
        ),
        *checks_for(
            "stg_orders",
            orders,
            not_null=["order_id", "customer_id"],
            unique=["order_id"],
            relationships={"customer_id": (customers, "customer_id")},
        ),
        *checks_for(
            "int_orders_enriched", enriched, not_null=["order_id", "customer_id"], unique=["order_id"]
        ),
        Check(
            "assert_no_orphan_orders_in_silver",
            "rule",
            orphans(orders.select("order_id", "customer_id"), customers, "customer_id"),
        ),
    ]


def gold_checks(dim_cust: DataFrame, dates: DataFrame, fct: DataFrame, mart: DataFrame) -> list[Check]:
    return [
        *checks_for("dim_customer", dim_cust, not_null=["customer_id", "email"], unique=["customer_id", "email"]),
        *checks_for("dim_date", dates, not_null=["date_key"], unique=["date_key"]),
        *checks_for(
            "fct_orders",
            fct,
            not_null=["order_id", "customer_id", "order_date_key", "order_amount"],
            unique=["order_id"],
            relationships={"customer_id": (dim_cust, "customer_id"), "order_date_key": (dates, "date_key")},
            ranges={"order_amount": (0, None)},
        ),
        *checks_for(
            "mart_sales_performance",
            mart,
            not_null=["order_month", "customer_id", "order_count", "total_revenue"],
            ranges={"order_count": (1, None)},
        ),
    ]


@job
def run_retail(
    bronze: dict[str, DataFrame],
    store: TableStore,
    run_ts: datetime,
    watermarks: DataFrame | None = None,
    full_refresh: bool = False,
    days: int = LOOKBACK_DAYS,
    publications: list[PublishSpec] = PUBLICATIONS,
    keep_failures: bool = True,
    customer_buckets: int = 16,
    load_sources: bool = False,
    catalog: bool = False,
) -> Report:
    """Load, freshness, Silver, history, Silver gate, Gold, Gold gate, publish, finish; a failed gate stops the run.

    ``bronze``: frames ``customers`` and ``orders``; with ``load_sources`` they are the sources, which the run lands and
    whose sync it logs and then checks. Orders are stored by order month, customers by key bucket
    (``customer_buckets`` should make a bucket the size of a file), and an incremental run rewrites only what it touches: the
    mart's months, too. The sources are synced by cursor, so rows deleted there stay until a sync without one; pass
    ``bronze`` frames that lack them to have them pruned. With ``catalog`` the Gold tables can be queried by name afterwards.
    """
    report = Report()
    if load_sources:
        bronze = load(store, BRONZE, bronze, SYNCS, run_ts, report)
        watermarks = store.read(WATERMARKS)
    require_fresh(watermarks, BRONZE, run_ts, report)
    month = F.date_format("order_date", "yyyy-MM")

    def stored(table: str) -> DataFrame | None:
        return None if full_refresh else store.read_or_none(table)

    def merge(table, batch, keys, mode, alive, part=None, buckets=None, log=False):
        if full_refresh:
            return store.overwrite(table, batch, keys, part, buckets=buckets)
        return store.merge(table, batch, keys, part, mode, alive, buckets, log=log)

    def silver_customers() -> DataFrame:
        name = f"{SILVER}/stg_customers"
        batch = stg_customers_batch(bronze["customers"], stored(name), run_ts, days)
        return merge(name, batch, ["customer_id"], "sync_all", (bronze["customers"], "id"), buckets=customer_buckets)

    def silver_orders() -> DataFrame:
        name = f"{SILVER}/stg_orders"
        batch = stg_orders_batch(bronze["orders"], stored(name), run_ts, days)
        return merge(name, batch, ["order_id"], "sync_all", (bronze["orders"], "id"), month)

    customers, orders = together(store.spark, [silver_customers, silver_orders])
    report.stages.append("silver")

    store_snapshot(store, f"{GOLD}/snap_stg_customers", customers, run_ts)
    report.stages.append("snapshot")

    pass_gate("silver gate", silver_checks(bronze, customers, orders), report, store, run_ts, keep_failures)

    enriched = int_orders_enriched(orders)

    def gold_customers() -> DataFrame:
        name = f"{GOLD}/dim_customer"
        batch = dim_customer_batch(customers, stored(name), run_ts, days)
        renamed = renamed_customers(batch, stored(name), customers)
        if renamed is not None:
            store.log_changes(f"{MART}/customers", renamed)
        return merge(name, batch, ["customer_id"], "sync_all", (customers, "customer_id"), buckets=customer_buckets)

    def gold_orders() -> DataFrame:
        name = f"{GOLD}/fct_orders"
        if not full_refresh:
            seen = enriched.select("order_id", "order_date", "order_status", "order_amount", names.EXTRACTED_AT)
            count_late(report, store, name, seen, ["order_id"], "order_date", month, days)
        batch = fct_orders_batch(enriched, stored(name), run_ts, days)
        return merge(name, batch, ["order_id"], "append_new", (orders, "order_id"), month, log=True)

    def gold_dates() -> DataFrame:
        return store.overwrite(f"{GOLD}/dim_date", dim_date(enriched, run_ts), ["date_key"])

    dim, fct, dates = together(store.spark, [gold_customers, gold_orders, gold_dates])
    mart = refresh_mart(store, dim, run_ts, full_refresh)
    report.stages.append("gold")

    pass_gate("gold gate", gold_checks(dim, dates, fct, mart), report, store, run_ts, keep_failures)
    publish_all(store, GOLD, publications, report)
    statistics = {f"{GOLD}/{t}": columns for t, columns in GOLD_STATISTICS.items()}
    finish(store, report, statistics if catalog else None)
    return report
