"""Numeric expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.text import _col


def money(c: Column | str, precision: int = 18, scale: int = 2) -> Column:
    return _col(c).cast(f"decimal({precision},{scale})")


def segment(c: Column | str, bounds: list[tuple[float | int | Decimal, str]], else_: str) -> Column:
    """Label of the first bound the value reaches; NULL and smaller values get ``else_``.

    ``bounds`` is listed from the highest minimum down.
    """
    value = _col(c)
    result = F
    for minimum, label in bounds:
        result = result.when(value >= F.lit(minimum), F.lit(label))
    return result.otherwise(F.lit(else_)) if bounds else F.lit(else_)


def unit_price(value: Column | str, quantity: Column | str, digits: int = 2) -> Column:
    """Value per unit, rounded half up; NULL unless the quantity is positive."""
    v, q = _col(value), _col(quantity)
    return F.when(q > 0, F.round(v / q, digits))
