from strata.functions.numbers import money, segment, unit_price
from strata.functions.text import blank_to_null, concat_key, norm
from strata.functions.time import as_instant, calendar_parts, month_start, utc_literal

__all__ = [
    "as_instant",
    "blank_to_null",
    "calendar_parts",
    "concat_key",
    "money",
    "month_start",
    "norm",
    "segment",
    "unit_price",
    "utc_literal",
]
