"""Sorted results and capped prefixes of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: So many rows of each task may meet in one task to be sorted.
DIRECT_TOP_ROWS = 10_000
SAMPLE_ROWS = 20_000


def top_k(df: DataFrame, by: str, k: int, ties: list[str]) -> DataFrame:
    """The k rows with the greatest ``by``; ``ties`` makes the cut deterministic."""
    return df.orderBy(F.col(by).desc_nulls_last(), *ties).limit(k)


def first_rows(df: DataFrame, keys: list[str], n: int, direct: int = DIRECT_TOP_ROWS) -> DataFrame:
    """The first n rows in key order, exactly and sorted, whatever the size of the table.

    A plain ORDER BY ... LIMIT n sends n rows of every task to one task. So for a large n the n-th key is closed in
    between two cuts: a sample of the keys in between proposes nearer ones, and counts tell on which side of them the n-th
    row lies. Once few rows lie in between, those alone are ordered to find the rest. ``df`` is read once for each round,
    so it should be stored if it is costly. Rows that agree in the keys are told apart by the remaining columns.
    """
    order = [*keys, *[c for c in _sortable(df) if c not in keys]]
    if n <= direct:
        return df.orderBy(*order).limit(n)
    total = df.count()
    if total <= n:
        return df.orderBy(*order)
    # rows up to ``low`` are taken whole, ``below`` in number; the n-th row is among the ``total`` ones after it, up to ``high``
    low, high, below, between = None, None, 0, df
    while total > direct:
        need = n - below
        sampled = between.select(F.struct(*order).alias("k")).sample(fraction=min(1.0, SAMPLE_ROWS / total), seed=17)
        marks = [tuple(r["k"]) for r in sampled.orderBy("k").collect()]  # some SAMPLE_ROWS keys
        place, slack = need * len(marks) // total, 2 * int(len(marks) ** 0.5) + 1
        cuts = [marks[i] for i in (place - slack, place + slack) if 0 <= i < len(marks)]
        if not cuts:
            break
        counts = between.agg(*[F.count_if(_at_or_below(df, order, c)).alias(f"n{i}") for i, c in enumerate(cuts)]).first()
        under = [(cut, count) for cut, count in zip(cuts, counts, strict=True) if count <= need]
        over = [(cut, count) for cut, count in zip(cuts, counts, strict=True) if count > need]
        taken, left = (under[-1][1] if under else 0), (over[0][1] if over else total)
        if left - taken == total:
            break  # rows that agree in all these columns: any of them will do
        low, high = (under[-1][0] if under else low), (over[0][0] if over else high)
        below, total = below + taken, left - taken
        between = df if high is None else df.filter(_at_or_below(df, order, high))
        between = between if low is None else between.filter(~_at_or_below(df, order, low))
    rest = between.orderBy(*order).limit(n - below)
    return rest if low is None else df.filter(_at_or_below(df, order, low)).unionByName(rest).orderBy(*order)


def _sortable(df: DataFrame) -> list[str]:
    kinds = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def _at_or_below(df: DataFrame, keys: list[str], cut: tuple) -> Column:
    """Lexicographic ``keys <= cut`` with NULL first, led by a plain bound on the first key for the scan."""
    lits = [
        F.lit(None if v is None else str(v)).cast(df.schema[k].dataType) for k, v in zip(keys, cut, strict=True)
    ]
    whole = F.struct(*keys) <= F.struct(*[v.alias(k) for k, v in zip(keys, lits, strict=True)])
    first = F.col(keys[0])
    lead = first.isNull() if cut[0] is None else (first <= lits[0]) | first.isNull()
    return lead & whole
