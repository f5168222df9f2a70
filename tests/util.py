from __future__ import annotations

from datetime import datetime


def ts(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)


def rows(df, *cols):
    """Rows as a set-like sorted list of tuples."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is None, str(v)) for v in r])


def plan(df) -> str:
    return df._jdf.queryExecution().toString()
