"""Tables as parquet folders that Spark itself can read, partitioned where a run changes only part of them.

A table lies under its name in Spark's own layout, ``_part=<value>`` folders if it is partitioned, and nothing else is kept
about it: its columns are those of its files, its partitions are its folders.

* A change by key rewrites the partitions it touches and no others, through Spark's dynamic partition overwrite. The rows
  that stay are read from the table itself; which folders are opened is decided by dynamic partition pruning from the
  touched partitions, a table of one column.
* A whole table is written beside the old one and then takes its place by renaming.

A change replaces files, so frames read before it have to be read again. Both can be run again after a failure: changes by key are decided anew, and nothing half-written has a table's name.
Where a catalog's format has MERGE INTO, use that instead.
"""

from __future__ import annotations

from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.conform import require_not_null, unused, with_run_ts
from strata.operators.dedupe import latest_per_key
from strata.operators.incremental import evolve
from strata.operators.joins import drop_keys, keep_keys
from strata.operators.prune import absent_rows

PART = "_part"
#: Repeated keys up to this number are sent to all tasks (8 bytes each).
SENT_KEYS = 100_000
#: Types of keys whose hashes are equal when they are.
_PLAIN = ("string", "boolean", "tinyint", "smallint", "int", "bigint", "date", "timestamp", "timestamp_ntz")


def key_bucket(keys: list[str], buckets: int) -> Column:
    """An even, stable partition of the key space; a batch of k keys touches at most k of its buckets. The value names the
    count, so that partitions of another count are told apart."""
    return F.concat(F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string"), F.lit(f"-of-{int(buckets)}"))


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._schemas: dict[str, T.StructType] = {}

    # ---- reading

    def exists(self, table: str) -> bool:
        path, old = self._dir(table), f"{self.root}/_swap/{table}.old"
        if not self._fs.exists(self._path(path)) and self._fs.exists(self._path(old)):
            self._move(old, path)  # a run ended between the two renames
        return self._fs.exists(self._path(path))

    def read(self, table: str, parts: list[str] | None = None) -> DataFrame:
        """The table; with ``parts`` only those partitions are opened."""
        df = self._load(table)
        if parts is not None and PART in df.columns:
            df = df.filter(F.col(PART).isin(parts) if parts else F.lit(False))
        return df.drop(PART)

    def read_parts(self, table: str, parts: DataFrame) -> DataFrame:
        """The rows of the partitions named by the one column ``_part`` of the frame; no others are opened.

        The names, at most one for each folder, are sent to all tasks. The comparison makes the optimizer
        expect that they select something, without which it would not prune by them.
        """
        return self._load(table).join(F.broadcast(parts.select(PART).distinct().filter(F.col(PART) >= "")), PART, "left_semi")

    def read_or_none(self, table: str) -> DataFrame | None:
        return self.read(table) if self.exists(table) else None

    def partitions(self, table: str) -> list[str]:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self._dir(table)))]
        return sorted(unquote(n.removeprefix(f"{PART}=")) for n in names if n.startswith(f"{PART}="))

    # ---- writing

    def overwrite(
        self,
        table: str,
        df: DataFrame,
        keys: list[str] | None = None,
        part: Column | None = None,
        file_rows: int | None = None,
        buckets: int | None = None,
        dealt: bool = False,
    ) -> DataFrame:
        """Replace the table, which the frame may read. ``keys`` sorts files by key, so that parquet min/max statistics
        prune; ``part`` is the expression to partition by, or ``buckets`` the number of buckets of the key; ``file_rows`` is
        the most rows per file. Rows that are ``dealt`` to their tasks by key, as those of ``latest_per_key``, go to their buckets
        from there without another shuffle: a bucket gets a file from each task, which AQE sizes."""
        part = key_bucket(keys, buckets) if buckets else part
        new, old = f"{self.root}/_swap/{table}.new", f"{self.root}/_swap/{table}.old"
        self._write(new, df, keys, part, file_rows, mode="overwrite", dealt=bool(dealt and buckets))
        if self.exists(table):
            self._fs.delete(self._path(old), True)
            self._move(self._dir(table), old)
        self._move(new, self._dir(table))
        self._fs.delete(self._path(old), True)
        self._schemas[table] = self._shape(df, part)
        return self.read(table)

    def merge(
        self,
        table: str,
        batch: DataFrame,
        keys: list[str],
        part: Column | None = None,
        on_schema_change: str = "append_new",
        alive: tuple[DataFrame, str] | None = None,
        buckets: int | None = None,
        file_rows: int | None = None,
        log: bool = False,
        dealt: bool = False,
    ) -> DataFrame:
        """delete+insert of the batch by key, then prune to the keys alive upstream.

        ``alive`` is (upstream, upstream key) and needs a single-column key. What changes is decided on
        key columns alone and written out: the batch, and the dead keys. Their size is then known from
        their files, so Spark broadcasts them while they are small and the stored wide rows are filtered
        in place; past its threshold it sort-merges. With ``part`` or ``buckets`` only partitions that gain or lose a
        row are read and rewritten. A row of ``part`` may move between partitions with its values, so stored keys are looked up
        in all of them; with ``buckets`` a key has one place. Another number of buckets, or other columns, rewrite the table.
        ``log`` notes the touched partitions (``*`` for the whole table) among the table's changes before they are rewritten. A first
        batch that is ``dealt`` goes to its buckets from the tasks it is in.
        """
        expression = key_bucket(keys, buckets) if buckets else part
        if not self.exists(table):
            if log:
                self.log_changes(table, self._everything())
            return self.overwrite(table, batch, keys, expression, file_rows, buckets, dealt)
        batch = self.stage(f"{table}/batch", batch)
        stored = self._load(table)
        parted = expression is not None and PART in stored.columns
        before, after = stored.drop(PART).schema, evolve(stored.drop(PART), batch, on_schema_change)[0].schema
        whole = (
            not parted
            or {(f.name, f.dataType) for f in before} != {(f.name, f.dataType) for f in after}
            or (buckets and any(not p.endswith(f"-of-{buckets}") for p in self.partitions(table)))
        )
        arriving = batch.select(*keys, (part_text(expression) if parted else F.lit("none")).alias(PART))
        known = stored.select(*keys, (F.col(PART) if PART in stored.columns else F.lit("none")).alias(PART))
        dead = None
        if alive:
            (key,) = keys
            dead = self.stage(f"{table}/dead", absent_rows(known.unionByName(arriving), alive[0], key, alive[1]))
        replaced = batch.select(*keys) if dead is None else batch.select(*keys).unionByName(dead.select(*keys))

        touched = arriving.select(PART)
        if not whole:
            if not buckets:
                touched = touched.union(keep_keys(known, arriving, keys, nulls_match=True).select(PART))
            if dead is not None:
                touched = touched.union(dead.select(PART))
            touched = self.stage(f"{table}/touched", touched.distinct().coalesce(1))
            if touched.isEmpty():
                return self.read(table)
        elif not parted and before == after and batch.isEmpty() and (dead is None or dead.isEmpty()):
            return self.read(table)
        target = stored if whole else self.read_parts(table, touched)
        kept, fresh = evolve(target.drop(PART), batch, on_schema_change)
        if dead is not None:
            kept, fresh = require_not_null(kept, keys), drop_keys(require_not_null(fresh, keys), dead, keys)
        merged = drop_keys(kept, replaced, keys, nulls_match=True).unionByName(fresh)
        if log:
            self.log_changes(table, self._everything() if whole else touched)
        if whole:
            return self.overwrite(table, merged, keys, expression, file_rows)
        # partitions that lose their last row; in buckets a replaced row is followed by one of its key. Those that get rows stay, so only
        # the others are looked into
        gone = []
        if dead is not None or not buckets:
            coming = arriving if dead is None else drop_keys(require_not_null(arriving, keys), dead, keys)
            emptied = drop_keys(touched, coming, PART).collect()
            if emptied:
                named = self.spark.createDataFrame(emptied, f"{PART} string")
                rest = self.read_parts(table, named).select(*keys, PART)
                left = drop_keys(rest if dead is None else require_not_null(rest, keys), replaced, keys, nulls_match=True)
                gone = [r[PART] for r in drop_keys(named, left, PART).collect()]
        self.replace_parts(table, merged, expression, gone, keys, file_rows)
        return self.read(table)

    def replace_parts(
        self,
        table: str,
        df: DataFrame,
        part: Column,
        gone: list[str],
        keys: list[str] | None = None,
        file_rows: int | None = None,
        dealt: bool = False,
    ) -> DataFrame:
        """Put the frame's partitions in place of the stored ones of the same name. The frame may read the table. Partitions
        named in ``gone`` that the frame does not fill disappear, all others stay as they are. With ``dealt`` rows go to their partitions
        from the tasks they are in."""
        if not self.exists(table):
            return self.overwrite(table, df, keys, part, file_rows)
        before = {p: self._stamp(table, p) for p in gone if p in self.partitions(table)}
        self._write(self._dir(table), df, keys, part, file_rows, mode="overwrite", dealt=dealt)
        stale = [p for p, stamp in before.items() if self._stamp(table, p) == stamp]
        for name in stale:
            self._fs.delete(self._path(f"{self._dir(table)}/{self._folder(name)}"), True)
        if stale and not self.partitions(table):
            self._write_empty(self._dir(table), df)
        self._schemas[table] = self._shape(df, part)
        return self.read(table)

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """Write an intermediate result out and read it back: cuts its lineage, tells its size. The
        next run's result of the same name replaces it."""
        path = f"{self.root}/_staging/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def latest(self, name: str, df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
        """``latest_per_key`` of a frame that can be read again, where few keys repeat: keys are counted by a hash of 8 bytes, and only rows
        whose hash occurs again are shuffled and ranked. Where many do, all rows are."""
        kinds = [df.schema[k].dataType.simpleString() for k in keys]
        if not all(kind in _PLAIN or kind.startswith("decimal") for kind in kinds):
            return latest_per_key(df, keys, order_cols)
        code = unused("_code", df)
        coded = df.withColumn(code, F.xxhash64(*keys))
        found = self.stage(f"{name}/repeated", coded.groupBy(code).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(code))
        n = found.count()
        if n > SENT_KEYS:
            return latest_per_key(df, keys, order_cols)
        if not n:
            return df
        again = latest_per_key(coded.join(F.broadcast(found), code, "left_semi").drop(code), keys, order_cols)
        return coded.join(F.broadcast(found), code, "left_anti").drop(code).unionByName(again)

    # ---- what changed

    def log_changes(self, name: str, df: DataFrame) -> None:
        """Add rows to the list of changes ``name``, which :meth:`changes` shows until :meth:`settle`."""
        df.write.mode("append").parquet(f"{self.root}/_changes/{name}")

    def changes(self, name: str) -> DataFrame | None:
        """What was logged since the list was last settled, also by runs that failed later on."""
        path = f"{self.root}/_changes/{name}"
        return self.spark.read.parquet(path).distinct() if self._fs.exists(self._path(path)) else None

    def settle(self, *names: str) -> None:
        """Forget changes that have been dealt with."""
        for name in names:
            self._fs.delete(self._path(f"{self.root}/_changes/{name}"), True)

    # ---- catalog

    def publish_to_catalog(self, table: str, name: str, analyze: list[str] | None = None) -> None:
        """Keep the catalog table ``name`` on the stored one, optionally with column statistics.

        The catalog table is declared over the table's folder once, and again only when its columns change. Later calls tell it
        of partitions that came or went, each through its own folder, so readers find it at any time.
        """
        stored = self._load(table)
        if self.spark.catalog.tableExists(name):
            described = [r.asDict() for r in self.spark.sql(f"DESCRIBE FORMATTED {name}").collect()]
            place = next((r["data_type"] for r in described if r["col_name"] == "Location"), "")
            same = [(f.name, f.dataType) for f in self.spark.table(name).schema] == [(f.name, f.dataType) for f in stored.schema]
            if not same or self._fs.makeQualified(self._path(place)) != self._fs.makeQualified(self._path(self._dir(table))):
                self.spark.sql(f"DROP TABLE {name}")
        parted = PART in stored.columns
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema)
            by = f"PARTITIONED BY ({PART})" if parted else ""
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {by} LOCATION '{self._dir(table)}'")
        if parted:
            known = {unquote(r[0].removeprefix(f"{PART}=")) for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect()}
            now = set(self.partitions(table))
            quoted = [[f"PARTITION ({PART}='{p.replace(chr(39), chr(92) + chr(39))}')" for p in sorted(x)] for x in (now - known, known - now)]
            for verb, specs, between in (("ADD IF NOT EXISTS", quoted[0], " "), ("DROP IF EXISTS", quoted[1], ", ")):
                for at in range(0, len(specs), 500):
                    self.spark.sql(f"ALTER TABLE {name} {verb} {between.join(specs[at : at + 500])}")
        self.spark.catalog.refreshTable(name)
        if analyze:
            analyze_table(self.spark, name, analyze)

    # ---- internals

    def _everything(self) -> DataFrame:
        return self.spark.createDataFrame([("*",)], f"{PART} string")

    def _dir(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def _move(self, old: str, new: str) -> None:
        self._fs.mkdirs(self._path(new).getParent())
        if not self._fs.rename(self._path(old), self._path(new)):
            raise OSError(f"{old} could not be renamed to {new}")

    def _folder(self, part: str) -> str:
        return f"{PART}={self._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(part)}"

    def _stamp(self, table: str, part: str) -> list[str]:
        """The files of a partition; written anew they have other names."""
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self._dir(table)}/{self._folder(part)}")))

    @staticmethod
    def _shape(df: DataFrame, part: Column | None) -> T.StructType:
        fields = [T.StructField(f.name, f.dataType) for f in df.schema if f.name != PART]
        return T.StructType([*fields, *([T.StructField(PART, T.StringType())] if part is not None else [])])

    def _load(self, table: str) -> DataFrame:
        """The table with the column that it is partitioned by, if it is."""
        if not self.exists(table):
            raise FileNotFoundError(f"no table {table} under {self.root}")
        path = self._dir(table)
        if table not in self._schemas:
            found = self.spark.read.parquet(path)
            self._schemas[table] = self._shape(found, F.lit("") if PART in found.columns else None)
        return self.spark.read.schema(self._schemas[table]).parquet(path)

    def _write(self, path: str, df: DataFrame, keys: list[str] | None, part: Column | None, file_rows: int | None, mode: str, dealt: bool = False) -> None:
        df = df.drop(PART)
        if part is None:
            out = layout(df, keys or [])
        else:
            out = df.withColumn(PART, part_text(part))
            # AQE cuts a hot partition into several tasks and files, and puts small ones together
            out = (out if dealt else out.hint("rebalance", PART)).sortWithinPartitions(PART, *(keys or []))
        writer = out.write.mode(mode).option("compression", "zstd")
        if file_rows:
            writer = writer.option("maxRecordsPerFile", file_rows)
        if part is None:
            writer.parquet(path)
            return
        # static where the folder is new, so that what a failed run left there goes
        dynamic = path != f"{self.root}/_swap" and not path.startswith(f"{self.root}/_swap/")
        writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static").partitionBy(PART).parquet(path)
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(path))]
        if not any(n.startswith(f"{PART}=") for n in names):
            self._write_empty(path, df)

    def _write_empty(self, path: str, df: DataFrame) -> None:
        """A partition without rows, which tells the columns of a table that has none."""
        df.limit(0).drop(PART).write.mode("overwrite").parquet(f"{path}/{PART}=none")


def part_text(part: Column) -> Column:
    return F.coalesce(part.cast("string"), F.lit("none"))


def layout(df: DataFrame, cols: list[str]) -> DataFrame:
    """Range-partition and sort by the columns: each file then covers a narrow key range and parquet
    statistics skip the rest, which is what an index on them is for."""
    return df.repartitionByRange(*cols).sortWithinPartitions(*cols) if cols else df


def bucket_table(df: DataFrame, name: str, keys: list[str], buckets: int, path: str | None = None) -> DataFrame:
    """Save the frame as catalog table ``name``, dealt to ``buckets`` by its keys and sorted by them.

    Joins and aggregates of such tables by these keys need no exchange on either side, if the counts agree.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def analyze_table(spark: SparkSession, name: str, cols: list[str]) -> None:
    """Refresh the optimizer's statistics of a catalog table."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(cols)}")


def build_view(df: DataFrame, name: str) -> DataFrame:
    """Name a derived relation for SQL without storing it."""
    df.createOrReplaceTempView(name)
    return df


def store_failures(
    store: TableStore, violations: DataFrame, test_name: str, run_ts: datetime, enabled: bool = True
) -> DataFrame | None:
    """Keep the failing rows of a check as an audit table (off in production)."""
    if not enabled:
        return None
    return store.overwrite(f"audit/{test_name}", with_run_ts(violations, run_ts, "checked_at"))
