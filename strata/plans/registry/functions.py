"""Scalar functions over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import blank_to_null, calendar_parts, concat_key, month_start, norm, segment, unit_price
from strata.plans.bronze import Tables
from strata.plans.registry.base import query


@query(
    "text_functions",
    """SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed, lower(trim(' ' || p_type)) AS lowered,
  upper(p_name) AS uppered, p_brand || '-' || p_type AS joined, CAST(length(p_name) AS INTEGER) AS name_length,
  nullif(p_brand, 'Brand#1') AS not_brand_1, coalesce(nullif(p_size, 1), 0) AS size_or_0,
  lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS padded,
  CASE WHEN p_size >= 10 THEN CAST(p_size AS BIGINT) END AS big_size, p_brand || '|' || nullif(p_type, 'SMALL') AS null_joined
FROM part""",
)
def text_functions(t: Tables) -> DataFrame:
    size = F.when(F.col("p_size") >= 10, F.concat(F.lit(" "), F.col("p_size").cast("string"))).otherwise("  ")
    return t.part.select(
        "p_partkey",
        norm(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
        norm(F.concat(F.lit(" "), "p_type"), "lower").alias("lowered"),
        norm("p_name", "upper").alias("uppered"),
        concat_key(["p_brand", "p_type"]).alias("joined"),
        F.length("p_name").alias("name_length"),
        F.nullif(F.col("p_brand"), F.lit("Brand#1")).alias("not_brand_1"),
        F.coalesce(F.nullif(F.col("p_size"), F.lit(1)), F.lit(0)).alias("size_or_0"),
        F.lpad(F.col("p_partkey").cast("string"), 10, "0").alias("padded"),
        blank_to_null(size, "bigint").alias("big_size"),
        concat_key(["p_brand", F.nullif(F.col("p_type"), F.lit("SMALL"))], "|").alias("null_joined"),
    )


@query(
    "number_functions",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
  CASE WHEN l_quantity > 10 THEN CAST((2 * CAST(l_extendedprice * 100 + 0.5 AS HUGEINT) + CAST(l_quantity - 10 AS HUGEINT))
    // (2 * CAST(l_quantity - 10 AS HUGEINT)) AS DOUBLE) / 100 END AS price_above_10,
  CASE WHEN nullif(l_extendedprice, 901.82) >= 70000 THEN 'large' WHEN nullif(l_extendedprice, 901.82) >= 30000 THEN 'medium'
    ELSE 'standard' END AS size_label,
  CAST(floor(l_tax * 100 + 0.5) AS BIGINT) AS tax_points, CAST(l_orderkey % 7 AS BIGINT) AS weekday_slot,
  (l_quantity = 0 AND l_linestatus = 'F') AS is_void, l_returnflag IN ('A', 'R') AS is_returned
FROM lineitem""".replace("CAST(l_extendedprice * 100 + 0.5 AS HUGEINT)", "CAST(round(l_extendedprice * 100) AS HUGEINT)"),
)
def number_functions(t: Tables) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(15,2)")
    above = (F.col("l_quantity") - 10).cast("decimal(13,3)")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_extendedprice",
        unit_price(price, above).cast("double").alias("price_above_10"),
        segment(
            F.nullif(F.col("l_extendedprice"), F.lit(901.82)), [(70_000, "large"), (30_000, "medium")], "standard"
        ).alias("size_label"),
        F.floor(F.col("l_tax") * 100 + 0.5).alias("tax_points"),
        (F.col("l_orderkey") % 7).alias("weekday_slot"),
        ((F.col("l_quantity") == 0) & (F.col("l_linestatus") == "F")).alias("is_void"),
        F.col("l_returnflag").isin("A", "R").alias("is_returned"),
    )


@query(
    "date_functions",
    """SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month_instant,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS month_day, CAST(o_orderdate AS DATE) AS day,
  o_orderdate - INTERVAL 3 DAYS AS three_days_before, CAST(CAST(o_orderdate AS DATE) - 7 AS DATE) AS week_before,
  CAST(CAST(o_orderdate AS DATE) + 14 AS DATE) AS two_weeks_after, o_orderdate + to_minutes(30) AS half_hour_later,
  CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS INTEGER) AS age_days
FROM orders""",
)
def date_functions(t: Tables) -> DataFrame:
    when, day = F.col("o_orderdate"), F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey",
        month_start(when, "timestamp_ntz").alias("month_instant"),
        month_start(when).alias("month_day"),
        day.alias("day"),
        (when - F.expr("INTERVAL 3 DAYS")).alias("three_days_before"),
        F.date_sub(day, 7).alias("week_before"),
        F.date_add(day, 14).alias("two_weeks_after"),
        (when + F.make_dt_interval(mins=F.lit(30))).alias("half_hour_later"),
        F.date_diff(F.lit("2002-01-01").cast("date"), day).alias("age_days"),
    )


@query(
    "calendar_parts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS year_number, CAST(quarter(ts) AS INTEGER) AS quarter_number,
  CAST(month(ts) AS INTEGER) AS month_number, CAST(weekofyear(ts) AS INTEGER) AS week_of_year,
  CAST(dayofweek(ts) AS INTEGER) AS day_of_week, dayname(ts) AS day_name, monthname(ts) AS month_name,
  dayofweek(ts) IN (0, 6) AS is_weekend FROM events""",
)
def event_calendar(t: Tables) -> DataFrame:
    day = F.col("ts").cast("date")
    return t.events.select("event_id", *[c.alias(n) for n, c in calendar_parts(day).items()])


@query(
    "array_functions",
    """SELECT p_partkey, ['FOB', 'CIF', 'DDP', 'EXW'][CAST(1 + p_size % 4 AS BIGINT)] AS incoterm,
  CAST(len(string_split(p_name, ' ')) AS INTEGER) AS n_words FROM part""",
)
def array_functions(t: Tables) -> DataFrame:
    terms = F.array(*[F.lit(x) for x in ("FOB", "CIF", "DDP", "EXW")])
    return t.part.select(
        "p_partkey",
        F.element_at(terms, F.col("p_size") % 4 + 1).alias("incoterm"),
        F.size(F.split("p_name", " ")).alias("n_words"),
    )
