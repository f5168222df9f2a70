"""A stream over a table that grows by a cursor: its offset is the pair (cursor, key) of the last row read.

Rows are read in the order of cursor and key, so of rows that share the bound's cursor value each is read once, by the batch
before the bound or the one behind it. What a batch has to read is cut into ranges of the cursor, each an input partition. The bound
comes from the statistics in the files' footers; only rows at the largest cursor value are looked at for their keys.

A row must not arrive with a cursor and key below the bound: it is not read any more. Use ``sync_table`` for such sources, or sources
that are no files.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

FORMAT = "strata_cursor"
SLICES = 8


@dataclass
class Slice(InputPartition):
    """Rows behind ``low`` up to ``high``, (cursor, key) as numbers, whose cursor is from ``first`` up to and without ``end``."""

    low: tuple[int, int] | None
    high: tuple[int, int]
    first: int
    end: int


class CursorSource(DataSource):
    """Options: ``path`` (a folder of parquet files that driver and executors reach), ``cursor`` (an instant, date or integer
    column), ``key`` (an integer column) and ``slices`` (input partitions of a batch)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return from_arrow_schema(_files(self.options["path"]).schema, prefer_timestamp_ntz=True)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return CursorReader(schema.fieldNames(), dict(self.options))


def _files(path: str) -> ds.Dataset:
    return ds.dataset(path.removeprefix("file://") if path.startswith("file:///") else path, format="parquet", exclude_invalid_files=False)


def _number(value: object, kind: pa.DataType) -> int:
    """A cursor value as the integer that it is stored as."""
    return pa.scalar(value, kind).cast(pa.int32() if pa.types.is_date32(kind) else pa.int64()).as_py()


class CursorReader(DataSourceStreamReader):
    def __init__(self, columns: list[str], options: dict[str, str]):
        self.columns, self.path = columns, options["path"]
        self.cursor, self.key, self.slices = options["cursor"], options["key"], int(options.get("slices", SLICES))

    def initialOffset(self) -> dict:
        return {"cursor": None, "key": None}

    def latestOffset(self) -> dict:
        files = _files(self.path)
        kind = files.schema.field(self.cursor).type
        most = None
        for fragment in files.get_fragments():
            for group in fragment.row_groups:
                found = (group.statistics or {}).get(self.cursor)
                if found and found["max"] is not None:
                    value = _number(found["max"], kind)
                    most = value if most is None else max(most, value)
        if most is None:
            return self.initialOffset()
        ties = files.scanner(columns=[self.key], filter=pc.field(self.cursor) == self._value(most, kind))
        keys = [pc.max(batch.column(0)).as_py() for batch in ties.to_batches() if batch.num_rows]
        return {"cursor": most, "key": max((k for k in keys if k is not None), default=None)}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        if end["cursor"] is None or start == end:
            return []
        low = None if start["cursor"] is None else (start["cursor"], start["key"])
        high = (end["cursor"], end["key"])
        first = low[0] if low else self._least()
        step = max(1, -(-(high[0] + 1 - first) // self.slices))
        return [Slice(low, high, a, min(high[0] + 1, a + step)) for a in range(first, high[0] + 1, step)]

    def read(self, part: Slice) -> Iterator[pa.RecordBatch]:
        files = _files(self.path)
        kind = files.schema.field(self.cursor).type
        cursor, key = pc.field(self.cursor), pc.field(self.key)
        wanted = (cursor >= self._value(part.first, kind)) & (cursor < self._value(part.end, kind))
        at = self._value(part.high[0], kind)
        wanted = wanted & ((cursor < at) | ((cursor == at) & (key <= part.high[1])))
        if part.low:
            at = self._value(part.low[0], kind)
            wanted = wanted & ((cursor > at) | ((cursor == at) & (key > part.low[1])))
        for batch in files.scanner(columns=self.columns, filter=wanted).to_batches():
            if batch.num_rows:
                yield batch

    def commit(self, end: dict) -> None:
        """Nothing to keep: the checkpoint has the offsets."""

    def _least(self) -> int:
        files = _files(self.path)
        kind = files.schema.field(self.cursor).type
        found = [(g.statistics or {}).get(self.cursor) for f in files.get_fragments() for g in f.row_groups]
        return min(_number(x["min"], kind) for x in found if x and x["min"] is not None)

    @staticmethod
    def _value(number: int, kind: pa.DataType) -> pa.Scalar:
        return pa.scalar(number, pa.int32() if pa.types.is_date32(kind) else pa.int64()).cast(kind)


def read_by_cursor(spark, path: str, cursor: str, key: str, slices: int = SLICES):
    """The stream of a folder's rows by cursor and key."""
    spark.dataSource.register(CursorSource)
    return spark.readStream.format(FORMAT).options(path=path, cursor=cursor, key=key, slices=str(slices)).load()
