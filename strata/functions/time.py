"""Dates and instants. Instants are UTC wall-clock values (``timestamp_ntz``) throughout."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.text import _col

INSTANT = "timestamp_ntz"


def as_instant(c: Column | str) -> Column:
    return _col(c).cast(INSTANT)


def utc_literal(value: datetime | date | str) -> Column:
    """A constant instant. Aware datetimes are shifted to UTC, naive ones are taken as UTC."""
    if isinstance(value, datetime) and value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(str(value)).cast(INSTANT)


def month_start(c: Column | str, to_type: str = "date") -> Column:
    """First day of the value's month, as a date or (``to_type=INSTANT``) as an instant."""
    return F.trunc(_col(c).cast("date"), "MM").cast(to_type)


def calendar_parts(day: Column | str) -> dict[str, Column]:
    """Calendar attributes of a date: ISO week, Sunday = 0, English names."""
    d = _col(day)
    weekday = F.dayofweek(d) - F.lit(1)
    return {
        "year_number": F.year(d),
        "quarter_number": F.quarter(d),
        "month_number": F.month(d),
        "week_of_year": F.weekofyear(d),
        "day_of_week": weekday,
        "day_name": F.date_format(d, "EEEE"),
        "month_name": F.date_format(d, "MMMM"),
        "is_weekend": weekday.isin(0, 6),
    }
