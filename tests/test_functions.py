from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strata.functions import blank_to_null, calendar_parts, concat_key, money, month_start, norm, segment, unit_price
from strata.functions.time import utc_literal
from tests.util import rows, ts


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def test_norm_strips_blanks_only(spark):
    assert one(spark, norm(F.lit("  A b\t "), "lower")) == "a b\t"
    assert one(spark, norm(F.lit(" x "), "upper")) == "X"
    assert one(spark, norm(F.lit(None).cast("string"))) is None


def test_blank_to_null(spark):
    assert one(spark, blank_to_null(F.lit("  "), "bigint")) is None
    assert one(spark, blank_to_null(F.lit(" 12 "), "smallint")) == 12
    with pytest.raises(PySparkException):
        one(spark, blank_to_null(F.lit("x1"), "bigint"))


def test_concat_key_propagates_null(spark):
    df = spark.createDataFrame([("45", "10"), (None, "10"), ("45", None)], "a string, b string")
    assert [r[0] for r in df.select(concat_key(["a", "b"])).collect()] == ["45-10", None, None]


def test_segment_bounds_and_null(spark):
    df = spark.createDataFrame(
        [(Decimal("1000.00"),), (Decimal("999.99"),), (Decimal("100.00"),), (Decimal("99.99"),), (None,)],
        "v decimal(18,2)",
    )
    got = [r[0] for r in df.select(segment("v", [(1000, "high"), (100, "medium")], "low")).collect()]
    assert got == ["high", "medium", "medium", "low", "low"]


def test_deal_segment_at_its_bounds(spark):
    from strata.plans.sap import DEAL_SEGMENTS, LOWEST_DEAL

    df = spark.createDataFrame([(500000.0,), (499999.99,), (100000.0,), (99999.99,)], "v double")
    got = [r[0] for r in df.select(segment("v", DEAL_SEGMENTS, LOWEST_DEAL)).collect()]
    assert got == ["large", "medium", "medium", "standard"]


def test_unit_price_guard_and_rounding(spark):
    df = spark.createDataFrame(
        [("10.00", "3.000"), ("0.05", "2.000"), ("5.00", "0.000"), ("5.00", None), (None, "1.000")], "v string, q string"
    ).select(money("v", 15, 2).alias("v"), F.col("q").cast("decimal(13,3)").alias("q"))
    got = [r[0] for r in df.select(unit_price("v", "q").cast("decimal(18,2)")).collect()]
    assert got == [Decimal("3.33"), Decimal("0.03"), None, None, None]


def test_utc_literal_shifts_aware_times(spark):
    aware = datetime(2024, 1, 1, 7, tzinfo=timezone(timedelta(hours=7)))
    assert one(spark, utc_literal(aware)) == datetime(2024, 1, 1)
    assert one(spark, utc_literal(datetime(2024, 1, 1, 5, 0, 0, 123456))) == datetime(2024, 1, 1, 5, 0, 0, 123456)


def test_month_start(spark):
    when = F.lit("2024-02-29 23:59:59").cast("timestamp_ntz")
    assert one(spark, month_start(when)) == date(2024, 2, 1)
    assert one(spark, month_start(when, "timestamp_ntz")) == datetime(2024, 2, 1)


@pytest.mark.parametrize(
    ("day", "week", "weekday", "weekend", "name"),
    [
        ("2024-12-30", 1, 1, False, "Monday"),
        ("2023-01-01", 52, 0, True, "Sunday"),
        ("2024-02-03", 5, 6, True, "Saturday"),
    ],
)
def test_calendar_parts(spark, day, week, weekday, weekend, name):
    parts = calendar_parts(F.lit(day).cast("date"))
    row = spark.range(1).select(*[c.alias(n) for n, c in parts.items()]).first()
    assert (row.week_of_year, row.day_of_week, row.is_weekend, row.day_name) == (week, weekday, weekend, name)


def test_calendar_of_a_leap_month(spark):
    from strata.operators.calendar import dim_date

    df = spark.createDataFrame([(ts("2024-02-27 05:00:00"),), (ts("2024-03-01 23:00:00"),), (None,)], "t timestamp_ntz")
    dim = dim_date(df, "t", datetime(2024, 4, 1))
    assert [r[0] for r in rows(dim, "date_key")] == [date(2024, 2, 27), date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]
    assert {r[0] for r in rows(dim, "month_name")} == {"February", "March"}


def test_date_spine_of_nothing_is_empty(spark):
    from strata.operators.calendar import date_spine

    assert date_spine(spark.createDataFrame([], "d date"), "d").count() == 0
    assert date_spine(spark.createDataFrame([(None,)], "d date"), "d").count() == 0
