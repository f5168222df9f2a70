"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import SHUFFLES_DROPPED, checkpoint_root, settings

#: Java and RE2 pattern of the white space that separates words.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{checkpoint_root(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: computed once, and safe when executors go. Its shuffle files go when it is
    written."""
    path = shared_path(df.sparkSession, name)
    with settings(df.sparkSession, SHUFFLES_DROPPED):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_for(df: DataFrame, least: int = 12) -> int:
    """Number of partitions to deal rows to: what the session is set to."""
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def utf8(column: str = "text"):
    """A text as UTF-8 bytes, NULL as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def batches_of(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch whose values add up to about ``limit`` bytes; one value may be longer."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += int(n)
    if start < len(sizes):
        yield start, len(sizes)


def without_columns(df: DataFrame, *names: str) -> DataFrame:
    """The frame less the columns that an operator is about to add, whatever their case."""
    taken = {name.lower() for name in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def shielded(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The frame with other names for columns that begin with ``__``, as helper columns do; and how to name them back."""
    taken, back = {c.lower() for c in df.columns}, {}
    for c in df.columns:
        if c.startswith("__"):
            name = f"own{c}"
            while name.lower() in taken:
                name += "_"
            taken.add(name.lower())
            back[name] = c
    return df.withColumnsRenamed({c: name for name, c in back.items()}), back


#: Ids up to this number are sent to all tasks (8 bytes each); more of them are joined by a shuffle.
SENT_IDS = 1_000_000


def drop_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is not among ``ids`` (one column doc_id, written out); NULL ids stay."""
    ids = ids.filter("doc_id is not null").distinct()
    if ids.count() <= SENT_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, "doc_id", "left_anti").select(docs.columns)
