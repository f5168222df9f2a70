"""Reading sources."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.conform import unused

SELECTORS = ("data", "value", "result")


@dataclass(frozen=True)
class SourceSpec:
    """One relational or file source table.

    For JDBC give ``url`` and, to read in parallel, ``partition_column`` with its bounds and the
    number of slices; ``cursor``/``last_value`` restrict the extract to new rows at the source.
    """

    table: str
    format: str = "parquet"
    path: str | None = None
    url: str | None = None
    schema: T.StructType | None = None
    columns: list[str] = field(default_factory=list)
    cursor: str | None = None
    last_value: object = None
    partition_column: str | None = None
    lower_bound: object = None
    upper_bound: object = None
    num_partitions: int | None = None
    options: dict[str, str] = field(default_factory=dict)


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """The source table, restricted to the wanted columns and the cursor range (both pushed down)."""
    reader = spark.read.format(spec.format).options(**spec.options)
    if spec.schema is not None:
        reader = reader.schema(spec.schema)
    if spec.format == "jdbc":
        reader = reader.options(url=spec.url, dbtable=spec.table)
        if spec.partition_column:
            reader = reader.options(
                partitionColumn=spec.partition_column,
                lowerBound=str(spec.lower_bound),
                upperBound=str(spec.upper_bound),
                numPartitions=str(spec.num_partitions or 8),
            )
        df = reader.load()
    else:
        df = reader.load(spec.path or spec.table)
    if spec.cursor and spec.last_value is not None:
        bound = F.lit(str(spec.last_value)).cast(df.schema[spec.cursor].dataType)
        df = df.filter(F.col(spec.cursor) >= bound)
    return df.select(*spec.columns) if spec.columns else df


def read_json_records(
    spark: SparkSession,
    path: str,
    selector: str | None = None,
    schema: T.StructType | None = None,
    whole_files: bool = True,
) -> DataFrame:
    """Rows of landed API responses: a top-level array, or an array under ``selector``.

    Without a selector the usual ones (data, value, result) are tried, but not one that ``schema`` has as a column.
    A single object is one row. Reading fails on a response in which no record can be found. A file is one response, or with ``whole_files=False`` each of its lines is one; such files are
    split between tasks.
    """
    if schema is not None and selector is None:
        return _records_of_texts(spark, path, schema, whole_files)
    reader = spark.read.option("multiLine", whole_files)
    if schema is not None:
        wrapped = T.StructType([T.StructField(selector, T.ArrayType(schema))])
        return reader.schema(wrapped).json(path).select(F.explode(selector).alias("r")).select("r.*")
    raw = reader.json(path)
    if selector is None:
        for name in SELECTORS:
            if name in raw.columns and isinstance(raw.schema[name].dataType, T.ArrayType):
                selector = name
                break
    if selector is None:
        return raw
    return raw.select(F.explode(selector).alias("r")).select("r.*")


def _records_of_texts(spark: SparkSession, path: str, schema: T.StructType, whole_files: bool) -> DataFrame:
    """Records wherever a response has them. A record may be all NULL; a response without any place for records fails."""
    tried = [s for s in SELECTORS if s not in schema.fieldNames()]
    texts = spark.read.text(path, wholetext=whole_files).filter(F.btrim(F.col("value"), F.lit(" \t\r\n")) != "")
    body = F.parse_json("value")
    arrays = [F.try_variant_get(body, f"$.{s}", "array<variant>") for s in tried]
    known = F.lit(False)
    for c in schema.fieldNames():
        known = known | F.try_variant_get(body, f"$['{c}']", "variant").isNotNull()
    nothing = F.raise_error(F.lit(f"no records, nor any of {', '.join(tried)}, in a response under {path}"))
    records = F.when(F.schema_of_variant(body).startswith("ARRAY"), F.try_variant_get(body, "$", "array<variant>")).otherwise(
        F.coalesce(*arrays, F.when(known, F.array(body)).otherwise(nothing))
    )
    each = texts.select(F.explode(records).alias("r"))
    return each.select(F.from_json(F.to_json("r"), schema).alias("r")).select("r.*")


def _once(df: DataFrame, *computed: str) -> DataFrame:
    """The frame with columns that filters and later columns read as they are. A filter on a column of a projection goes below it with all
    that computes the column, which then runs once more for each time it is named; it doesn't go below a generator."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in computed]
    return df.select(*kept, F.inline(F.array(F.struct(*computed))))


def split_responses(
    df: DataFrame, payload: str, fields: dict[str, str], required: list[str] | None = None, selectors: tuple[str, ...] = SELECTORS
) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine) of API responses held as JSON text in a column, whatever shape each response has.

    A body is parsed to VARIANT. Its records are the elements of a top-level array, of the array under the first selector that
    it has, or the one object that it is. A record's ``fields`` (name to SQL type, from the JSON field of that name) are
    cast one by one; fields it has beside them go to ``extra``, as JSON text, so new ones are not lost. The quarantine has
    a row per body that can't be parsed or holds no records (``reason`` malformed, empty or no records), and per record that is no object or
    has a field that doesn't fit or a ``required`` one that is missing or null (not an object, bad <field>, missing <field>), with
    what it concerns as ``content``. Other columns are kept in both. NULL bodies are empty ones.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c != payload]
    names = [unused(n, df) for n in ("_body", "_record", "_reason", "_records")]
    body, record, reason, found = names
    blank = F.coalesce(F.btrim(F.col(payload), F.lit(" \t\r\n")), F.lit("")) == ""
    parsed = df.withColumn(body, F.try_parse_json(payload))
    v = F.col(body)
    # an array, the array under the first selector, or the object itself
    arrays = [F.try_variant_get(v, path, "array<variant>") for path in ("$", *[f"$.{s}" for s in selectors])]
    records = F.coalesce(*arrays, F.when(F.try_variant_get(v, "$", "map<string,variant>").isNotNull(), F.array(v)))
    why = F.when(blank, "empty").when(v.isNull(), "malformed").when(F.col(found).isNull(), "no records")
    judged = _once(_once(parsed, body).withColumn(found, records).withColumn(reason, why), found, reason)
    bad_bodies = judged.filter(F.col(reason).isNotNull()).select(*kept, F.col(reason).alias("reason"), F.col(payload).alias("content"))
    each = judged.filter(F.col(reason).isNull()).select(*kept, F.explode(found).alias(record))
    r = F.col(record)
    whole = F.try_variant_get(r, "$", "map<string,variant>")
    checks = F.when(whole.isNull(), "not an object")
    values = {}
    for name, kind_ in fields.items():
        at = f"$['{name}']"
        values[name] = F.try_variant_get(r, at, kind_)
        there = F.try_variant_get(r, at, "variant")
        given = there.isNotNull() & ~F.is_variant_null(there)
        lost = values[name].isNull()
        if kind_ in ("tinyint", "smallint", "int", "bigint"):  # a cast cuts fractions off
            lost = lost | (F.try_variant_get(r, at, "double") != values[name].cast("double"))
        checks = checks.when(given & lost, f"bad {name}")
        if name in (required or []):
            checks = checks.when(~F.coalesce(given, F.lit(False)), f"missing {name}")
    others = F.map_filter(whole, lambda k, _: ~k.isin(*fields))
    told = _once(each.withColumn(reason, checks), reason)
    good = told.filter(F.col(reason).isNull()).select(
        *kept, *[c.alias(n) for n, c in values.items()], F.when(F.size(others) > 0, F.to_json(others)).alias("extra")
    )
    bad = told.filter(F.col(reason).isNotNull()).select(*kept, F.col(reason).alias("reason"), F.to_json(r).alias("content"))
    return good, bad_bodies.unionByName(bad)


def explode_records(df: DataFrame, payload: str, record: T.StructType, selector: str | None = None) -> DataFrame:
    """Rows of API responses held as JSON text in a column; other columns are kept."""
    array = T.ArrayType(record)
    kept = [c for c in df.columns if c != payload]
    if selector is None:
        parsed = F.from_json(payload, array)
    else:
        parsed = F.from_json(payload, T.StructType([T.StructField(selector, array)]))[selector]
    return df.select(*kept, F.explode(parsed).alias("_record")).select(*kept, "_record.*")
