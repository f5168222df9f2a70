"""Publishing tables as consumer-facing copies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import columns as names
from strata.operators.ranking import first_rows
from strata.sources.store import TableStore

# Rows per batch that the publishing tool sends, and the least it accepts.
BATCH_ROWS = 2_000
MIN_BATCH_ROWS = 100

# Column types of the published form; any other type is published as text.
PUBLISHED_TYPES = {
    "integer": "int",
    "bigint": "int",
    "smallint": "int",
    "numeric": "numeric",
    "double precision": "float",
    "real": "float",
    "boolean": "bool",
    "date": "date",
    "timestamp without time zone": "timestamp",
    "timestamp with time zone": "timestamp",
    "text": "text",
    "character varying": "text",
}

_SQL_NAMES: list[tuple[type, str]] = [
    (T.IntegerType, "integer"),
    (T.LongType, "bigint"),
    (T.ShortType, "smallint"),
    (T.DecimalType, "numeric"),
    (T.DoubleType, "double precision"),
    (T.FloatType, "real"),
    (T.BooleanType, "boolean"),
    (T.DateType, "date"),
    (T.TimestampNTZType, "timestamp without time zone"),
    (T.TimestampType, "timestamp with time zone"),
    (T.VarcharType, "character varying"),
    (T.StringType, "text"),
]


@dataclass(frozen=True)
class PublishSpec:
    """What to publish: a table and its key. All rows, unless ``max_rows`` caps them. The copy is stored in ``buckets`` of the
    key, which should make a bucket the size of a file."""

    table: str
    keys: tuple[str, ...]
    max_rows: int | None = None
    batch_rows: int = BATCH_ROWS
    source: str = ""
    buckets: int = 16

    def __post_init__(self) -> None:
        if not self.keys or isinstance(self.keys, str):
            raise ValueError(f"{self.table}: keys must name at least one column")


def published_fields(df: DataFrame) -> list[tuple[str, str]]:
    """(column, published type) in table order."""

    def sql_name(kind: T.DataType) -> str:
        return next((name for cls, name in _SQL_NAMES if isinstance(kind, cls)), "other")

    return [(f.name, PUBLISHED_TYPES.get(sql_name(f.dataType), "text")) for f in df.schema.fields]


def to_records(df: DataFrame) -> DataFrame:
    """Values as published: ISO dates and instants, decimals as doubles, everything else as it is."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            # fractional seconds appear only when there are any
            whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
            micros = F.date_format(c, "SSSSSS")
            c = F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))
            if isinstance(f.dataType, T.TimestampType):
                c = F.concat(c, F.lit("+00:00"))
        out.append(c.alias(f.name))
    return df.select(*out)


def to_json_lines(df: DataFrame) -> DataFrame:
    """One JSON document per row, in column ``record``; NULL fields are written out."""
    return to_records(df).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))


def capped(df: DataFrame, spec: PublishSpec) -> DataFrame:
    """The rows to publish: the first ``max_rows`` in key order, or all."""
    return df if spec.max_rows is None else first_rows(df, list(spec.keys), spec.max_rows)


def publish(
    store: TableStore, df: DataFrame, spec: PublishSpec, folder: str = "published"
) -> tuple[DataFrame, DataFrame]:
    """Upsert the rows to publish into the published copy; of a capped one files hold at most ``batch_rows`` rows. Files of an
    uncapped one don't: there would be more of them with every row.

    Rows published earlier stay until a row of the same key (NULL equal to NULL) replaces them; new columns are added to
    the copy. Without a cap only rows built since the copy's newest one was are read, and only their buckets are rewritten.
    Returns the copy and the rows of this run.
    """
    keys, name = list(spec.keys), f"{folder}/{spec.table}"
    if spec.max_rows is None and names.BUILT_AT in df.columns and store.exists(name):
        df = df.filter(F.col(names.BUILT_AT) >= F.lit(_newest(store.read(name))).cast(df.schema[names.BUILT_AT].dataType))
    rows = to_records(store.latest(name, df, keys, []))
    if spec.max_rows is None:
        if not store.exists(name):
            copy = store.overwrite(name, rows, keys, buckets=spec.buckets, dealt=True)
            return copy, copy
        rows = store.stage(f"{name}/rows", rows)
        return store.merge(name, rows, keys, buckets=spec.buckets), rows
    rows = store.stage(f"{name}/capped", capped(store.stage(f"{name}/rows", rows), spec))
    return store.merge(name, rows, keys, buckets=spec.buckets, file_rows=max(MIN_BATCH_ROWS, spec.batch_rows)), rows


def _newest(copy: DataFrame) -> str:
    """When the newest row of a published copy was built; the epoch if it doesn't say."""
    if names.BUILT_AT not in copy.columns:
        return "1970-01-01"
    return copy.agg(F.coalesce(F.max(names.BUILT_AT), F.lit("1970-01-01"))).first()[0]


def export_csv(df: DataFrame, path: str) -> None:
    """The published rows as CSV with a header."""
    to_records(df).write.mode("overwrite").option("header", True).csv(path)


def publication_scope(rows: DataFrame, limit: int | None, source: str) -> DataFrame:
    """How many rows a run published, under which cap, from where, and whether the cap was reached."""
    reached = F.lit(False) if limit is None else (F.col("published_rows") >= limit) & F.lit(limit > 0)
    return rows.agg(F.count(F.lit(1)).alias("published_rows")).select(
        F.lit(source).alias("warehouse_source"),
        "published_rows",
        F.lit(limit).cast("bigint").alias("publish_limit"),
        reached.alias("is_capped"),
    )
