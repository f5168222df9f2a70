"""Text conforming, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CASES = {"lower": F.lower, "upper": F.upper}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm(c: Column | str, case: str | None = None) -> Column:
    """Strip surrounding blanks (blanks only, not tabs) and optionally fold case."""
    trimmed = F.trim(_col(c))
    return CASES[case](trimmed) if case else trimmed


def blank_to_null(c: Column | str, to_type: str) -> Column:
    """Cast text to ``to_type``; an empty or all-blank text becomes NULL, bad text raises (ANSI)."""
    return F.nullif(F.trim(_col(c)), F.lit("")).cast(to_type)


def concat_key(cols: list[Column | str], sep: str = "-") -> Column:
    """Join parts into one key; NULL if any part is NULL (unlike ``concat_ws``)."""
    pieces: list[Column] = []
    for c in cols:
        if pieces:
            pieces.append(F.lit(sep))
        pieces.append(_col(c).cast("string"))
    return F.concat(*pieces)
