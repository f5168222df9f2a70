"""Mining the logs of past runs: which check failed, with what result, and how runs ended.

A log is split into lines, each line that carries a known marker opens an entry, and lines without one belong to the
entry above them. All of that happens within the row of the log, so logs are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# What the transformation tool prints ahead of each kind of message.
MARKERS = {
    "failure": "Failure in test ",
    "totals": "Done. PASS=",
    "source": "Source '",
    "model": "== [",
    "database": "Database Error",
}
RESULT, COMPILED = "Got ", "compiled code at "
# What a source is called that is not fresh.
STALE_WORDS = ["exceeded", "error", "stale"]
TOTALS = ["pass", "warn", "error", "skip", "total"]

#: The library's own kinds of checks, as they occur in names of checks.
CHECK_KINDS = ["not_null", "unique", "relationships", "accepted_range", "freshness"]


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """(run, block, line, message) of the log files under ``path``: a run is a file, a block a split of it, and ``line`` grows within the block.

    Files of any size are read in splits, line by line; ``message`` is free of colors and of what the scheduler writes ahead. Blank
    lines are left out.
    """
    read = spark.read.option("recursiveFileLookup", True).text(path)
    lines = read.select(
        F.col("_metadata.file_path").alias("run"),
        F.col("_metadata.file_block_start").alias("block"),
        # a split is read by one task from its first line on
        F.monotonically_increasing_id().alias("line"),
        _message(F.col("value")).alias("message"),
    )
    return lines.filter("message <> ''")


def _opens(line: Column) -> Column:
    """The kind of entry that a line opens, if any."""
    return F.coalesce(*[F.when(line.contains(marker), F.lit(name)) for name, marker in MARKERS.items()])


def line_entries(lines: DataFrame) -> DataFrame:
    """Lines with the entry they belong to: its ``kind``, and ``opened_block`` and ``opened_line``, where it begins.

    Within a block the last opening line is carried forward. A block that begins within an entry takes the last one opened in an earlier block
    of its file; for that one row a block is enough, so no task sees more lines than a block has. Lines ahead of all entries go.
    """
    here = F.struct("block", "line", F.col("opens").alias("kind"))
    marked = lines.withColumn("opens", _opens(F.col("message")))
    in_block = Window.partitionBy("run", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = marked.withColumn("own", F.last(F.when(F.col("opens").isNotNull(), here), ignorenulls=True).over(in_block))
    last = marked.groupBy("run", "block").agg(F.max(F.when(F.col("opens").isNotNull(), here)).alias("last"))
    before = Window.partitionBy("run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("run", "block", F.last("last", ignorenulls=True).over(before).alias("carried"))
    found = own.join(carried, ["run", "block"]).withColumn("entry", F.coalesce("own", "carried")).filter("entry is not null")
    return found.select("run", "block", "line", "message", F.col("entry.kind").alias("kind"), F.col("entry.block").alias("opened_block"), F.col("entry.line").alias("opened_line"))


_ENTRY = ["run", "opened_block", "opened_line"]


def _first_line(where: Column | None = None) -> Column:
    """The first message of an entry, or the first for which the condition holds."""
    at = F.struct("block", "line", "message")
    return F.min(at if where is None else F.when(where, at))["message"]


def failed_checks_of_lines(lines: DataFrame) -> DataFrame:
    """:func:`failed_checks` for logs read line by line."""
    failures = line_entries(lines).filter("kind = 'failure'")
    entries = failures.groupBy(*_ENTRY).agg(
        _first_line().alias("head"), *[_first_line(F.col("message").startswith(m)).alias(n) for n, m in (("got", RESULT), ("compiled", COMPILED))]
    )
    head = _after(F.col("head"), MARKERS["failure"])
    name = F.trim(F.substring_index(head, " (", 1))
    ordered = Window.partitionBy("run").orderBy("opened_block", "opened_line")
    return entries.select(
        "run",
        (F.row_number().over(ordered) - 1).alias("block"),
        name.alias("test_name"),
        F.nullif(F.btrim(_after(head, " ("), F.lit(") ")), F.lit("")).alias("test_resource"),
        F.nullif(F.trim(_after(F.col("got"), RESULT)), F.lit("")).alias("result_line"),
        F.nullif(F.trim(_after(F.col("compiled"), COMPILED)), F.lit("")).alias("compiled_path"),
        check_kind(name).alias("test_type"),
    )


def run_totals_of_lines(lines: DataFrame) -> DataFrame:
    """:func:`run_totals` for logs read line by line. A log without entries has a row, too."""
    runs = lines.select("run").distinct()
    told = F.lower("message")
    # behind the source's quoted name, on the line that opens the entry, and anywhere on later ones
    tail = F.regexp_extract(told, "source '[^']*'(.*)", 1)
    words = F.exists(F.array(*map(F.lit, STALE_WORDS)), lambda w: F.contains(F.when(F.col("line") == F.col("opened_line"), tail).otherwise(told), w))
    entries = line_entries(lines).groupBy(*_ENTRY, "kind").agg(
        _first_line().alias("head"),
        _first_line((F.col("block") != F.col("opened_block")) | (F.col("line") != F.col("opened_line"))).alias("second"),
        F.max(words).alias("stale"),
    )
    place = F.struct("opened_block", "opened_line", "head", "second")

    def first(where: Column) -> Column:
        return F.min(F.when(where, place))

    kind = F.col("kind")
    found = entries.groupBy("run").agg(
        first(kind == "totals")["head"].alias("totals"),
        first((kind == "source") & F.col("stale"))["head"].alias("source"),
        first((kind == "model") & F.col("head").contains("] FAIL"))["head"].alias("model"),
        first(kind == "database")["second"].alias("database_error"),
        F.count_if(kind == "failure").alias("n_failed_checks"),
    )
    counts = F.str_to_map(F.concat(F.lit("PASS="), _after(F.col("totals"), MARKERS["totals"])), F.lit(" "), F.lit("="))
    rows = runs.join(found, "run", "left").select(
        "run",
        *[F.try_element_at(counts, F.lit(name.upper())).try_cast("bigint").alias(f"n_{name}") for name in TOTALS],
        F.substring_index(_after(F.col("source"), MARKERS["source"]), "'", 1).alias("stale_source"),
        F.substring_index(_after(F.col("model"), MARKERS["model"]), "]", 1).alias("failed_model"),
        "database_error",
        F.coalesce("n_failed_checks", F.lit(0)).cast("bigint").alias("n_failed_checks"),
    )
    return rows.withColumn("state", _state())


def _state() -> Column:
    """How a run ended, by its totals."""
    broken = (
        (F.coalesce("n_error", F.lit(0)) > 0)
        | (F.col("n_failed_checks") > 0)
        | F.col("stale_source").isNotNull()
        | F.col("failed_model").isNotNull()
        | F.col("database_error").isNotNull()
    )
    return F.when(broken, "failed").when(F.coalesce("n_warn", F.lit(0)) > 0, "warned").otherwise("success")


def read_run_logs(spark: SparkSession, path: str) -> DataFrame:
    """One row per log file, whole: (run, log). For logs that are large, see :func:`read_log_lines`."""
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(
        F.input_file_name().alias("run"), F.col("value").alias("log")
    )


def _after(text: Column, marker: str) -> Column:
    """What follows the first occurrence of the marker; NULL without one."""
    at = F.instr(text, marker)
    return F.when(at > 0, F.substr(text, at + F.lit(len(marker))))


def _message(line: Column) -> Column:
    """A line without terminal colors, and without the scheduler's "[time] {file} LEVEL - " ahead of it."""
    plain = F.regexp_replace(line, "\x1b\\[[0-9;]*[A-Za-z]", "")
    scheduled = plain.startswith("[") & plain.contains("] {")
    return F.trim(F.translate(F.when(scheduled, F.coalesce(_after(plain, " - "), F.lit(""))).otherwise(plain), "\t\r", "  "))


def _entries(logs: DataFrame) -> DataFrame:
    """(run, entries): an array of (kind, lines) per log."""

    lines = logs.select(
        "run", F.filter(F.transform(F.split(F.coalesce("log", F.lit("")), "\n"), _message), lambda line: line != "").alias("lines")
    )
    kinds = lines.withColumn("kinds", F.transform("lines", _opens))
    starts = kinds.withColumn(
        "starts",
        F.filter(F.transform("kinds", lambda k, i: F.when(k.isNotNull(), i)), lambda i: i.isNotNull()),
    )
    entries = F.transform(
        "starts",
        lambda s, j: F.struct(
            F.get("kinds", s).alias("kind"),
            F.slice("lines", s + 1, F.coalesce(F.get("starts", j + 1), F.size("lines")) - s).alias("lines"),
        ),
    )
    return starts.select("run", entries.alias("entries"))


def _of(kind: str) -> Column:
    return F.filter("entries", lambda e: e["kind"] == kind)


def check_kind(name: Column) -> Column:
    """The kind of check that a name mentions first, else ``generic``."""
    low = F.lower(name)
    places = F.array(*[F.struct(F.instr(low, kind).alias("at"), F.lit(kind).alias("kind")) for kind in CHECK_KINDS])
    return F.coalesce(F.array_min(F.filter(places, lambda p: p["at"] > 0))["kind"], F.lit("generic"))


def failed_checks(logs: DataFrame) -> DataFrame:
    """One row per failing check of each run: name, resource, result, compiled file, kind."""
    found = _entries(logs).select("run", F.posexplode(_of("failure")).alias("block", "entry"))
    head = _after(F.get("entry.lines", F.lit(0)), MARKERS["failure"])
    name = F.trim(F.substring_index(head, " (", 1))

    def detail(marker: str) -> Column:
        line = F.get(F.filter("entry.lines", lambda x: x.startswith(marker)), F.lit(0))
        return F.nullif(F.trim(_after(line, marker)), F.lit(""))

    return found.select(
        "run",
        "block",
        name.alias("test_name"),
        F.nullif(F.btrim(_after(head, " ("), F.lit(") ")), F.lit("")).alias("test_resource"),
        detail(RESULT).alias("result_line"),
        detail(COMPILED).alias("compiled_path"),
        check_kind(name).alias("test_type"),
    )


def run_totals(logs: DataFrame) -> DataFrame:
    """One row per run: its totals, stale source, failed model, database error and end state.

    A source is stale if a word for that stands after its name, on its line or on those up to the next entry.
    """
    entries = _entries(logs)
    totals = F.get(_of("totals"), F.lit(0))["lines"]
    counts = F.str_to_map(F.concat(F.lit("PASS="), _after(F.get(totals, F.lit(0)), MARKERS["totals"])), F.lit(" "), F.lit("="))

    def told(e: Column) -> Column:
        text = F.lower(F.array_join(e["lines"], "\n"))
        words = F.substr(text, F.instr(text, "'") + F.lit(1))
        words = F.substr(words, F.instr(words, "'") + F.lit(1))
        return (e["kind"] == "source") & F.exists(F.array(*map(F.lit, STALE_WORDS)), lambda w: F.contains(words, w))

    source = F.get(F.filter("entries", told), F.lit(0))["lines"]
    models = F.filter("entries", lambda e: (e["kind"] == "model") & F.get(e["lines"], F.lit(0)).contains("] FAIL"))
    model = F.get(models, F.lit(0))["lines"]
    database = F.get(_of("database"), F.lit(0))["lines"]
    rows = entries.select(
        "run",
        *[F.try_element_at(counts, F.lit(name.upper())).try_cast("bigint").alias(f"n_{name}") for name in TOTALS],
        F.substring_index(_after(F.get(source, F.lit(0)), MARKERS["source"]), "'", 1).alias("stale_source"),
        F.substring_index(_after(F.get(model, F.lit(0)), MARKERS["model"]), "]", 1).alias("failed_model"),
        F.get(database, F.lit(1)).alias("database_error"),
        F.size(_of("failure")).cast("bigint").alias("n_failed_checks"),
    )
    return rows.withColumn("state", _state())


def count_by_state(runs: DataFrame, group: str = "state") -> DataFrame:
    return runs.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_runs"), F.sum(F.coalesce("n_error", F.lit(0))).alias("n_errors")
    )


def task_states(task_runs: DataFrame) -> DataFrame:
    """Tasks per run and state: one row per run, one count per outcome."""
    return task_runs.groupBy("run").agg(
        F.count_if(F.col("state") == "success").alias("n_success"),
        F.count_if(F.col("state") == "failed").alias("n_failed"),
        F.count_if(F.col("state") == "upstream_failed").alias("n_upstream_failed"),
    )
