"""Freshness, run logs and the streaming upsert over the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.quality import freshness, freshness_status
from strata.plans.bronze import Tables
from strata.plans.registry.base import query
from strata.plans.registry.incremental import NEWEST_EVENT
from strata.plans.registry.loads import watermarks
from strata.session import checkpoint_root
from strata.sources import runlog
from strata.sources.store import TableStore
from strata.streaming.cursor_source import read_by_cursor
from strata.streaming.upsert import stream_upsert

NOW = "2024-02-01 00:00:00"


# one schema per user; its age decides
@query(
    "freshness_status",
    f"""WITH w AS (SELECT CAST(user_id AS VARCHAR) AS bronze_schema, max(ts) AS synced_at FROM events GROUP BY 1),
a AS (SELECT *, CAST((epoch_us(TIMESTAMP '{NOW}') - epoch_us(synced_at)) // 1000000 AS BIGINT) AS age_seconds FROM w)
SELECT *, CASE WHEN age_seconds > 172800 THEN 'error' WHEN age_seconds > 129600 THEN 'warn' ELSE 'pass' END AS status
FROM a""",
)
def user_freshness(t: Tables) -> DataFrame:
    last = t.events.groupBy(F.col("user_id").cast("string").alias("bronze_schema")).agg(F.max("ts").alias("synced_at"))
    return freshness_status(last, NOW)


@query(
    "freshness_expected",
    f"""WITH w AS (SELECT event_type AS bronze_schema, max(ts) AS synced_at FROM events GROUP BY 1),
e AS (SELECT unnest(['click', 'error', 'never_synced', 'view']) AS bronze_schema),
a AS (SELECT e.bronze_schema, synced_at,
  CAST((epoch_us(TIMESTAMP '{NOW}') - epoch_us(synced_at)) // 1000000 AS BIGINT) AS age_seconds
  FROM e LEFT JOIN w ON e.bronze_schema = w.bronze_schema)
SELECT *, CASE WHEN age_seconds IS NULL OR age_seconds > 172800 THEN 'error' WHEN age_seconds > 129600 THEN 'warn'
  ELSE 'pass' END AS status FROM a""",
)
def expected_freshness(t: Tables) -> DataFrame:
    return freshness(watermarks(t.events), ["click", "error", "never_synced", "view"], NOW)


def run_logs(t: Tables) -> DataFrame:
    """A run log per event, with its user, in the form the transformation tool and the scheduler write it."""
    k = F.get_json_object("props", "$.k")
    prefix = F.concat(F.lit("["), F.col("ts").cast("string"), F.lit("] {job.py:63} INFO - "))
    failure = F.concat(
        prefix,
        F.lit("\x1b[31mFailure in test not_null_orders_"),
        "event_type",
        F.lit(" (models/"),
        "event_type",
        F.lit(".yml)\x1b[0m\n"),
        prefix,
        F.lit("  Got "),
        k,
        F.lit(" results, configured to fail if != 0\n\n"),
        prefix,
        F.lit("  compiled code at target/"),
        F.col("user_id").cast("string"),
        F.lit(".sql\n"),
    )
    totals = F.concat(
        prefix,
        F.lit("Done. PASS="),
        k,
        F.when(F.col("event_type") == "view", " WARN=1").otherwise(" WARN=0"),
        F.when(F.col("event_type") == "error", " ERROR=1").otherwise(" ERROR=0"),
        F.lit(" SKIP=0 TOTAL="),
        k,
        F.lit("\n"),
    )
    log = F.concat(F.lit("Running\n"), F.when(F.col("event_type") == "error", failure).otherwise(""), totals)
    return t.events.select(F.col("event_id").alias("run"), "user_id", log.alias("log"))


@query(
    "run_log_failures",
    """SELECT event_id AS run, 0 AS block, 'not_null_orders_error' AS test_name, 'models/error.yml' AS test_resource,
  json_extract_string(props, '$.k') || ' results, configured to fail if != 0' AS result_line,
  'target/' || user_id || '.sql' AS compiled_path, 'not_null' AS test_type FROM events WHERE event_type = 'error'""",
)
def run_log_failures(t: Tables) -> DataFrame:
    return runlog.failed_checks(run_logs(t))


@query(
    "run_log_states",
    """SELECT CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'warned' ELSE 'success' END AS state,
  count(*) AS n_runs, count_if(event_type = 'error') AS n_errors FROM events GROUP BY 1""",
)
def run_log_states(t: Tables) -> DataFrame:
    return runlog.count_by_state(runlog.run_totals(run_logs(t)))


#: The files that logs are put in, the splits that a file of middle size is cut into, and the least and greatest size of a split in bytes.
LOG_FILES, LOG_SPLITS, LEAST_SPLIT, MOST_SPLIT = 20, 16, 2 << 10, 128 << 20


def log_files(t: Tables) -> str:
    """The runs' logs as files, each of the users whose numbers end alike: the logs of their events one after the other."""
    folder = f"{checkpoint_root(t.spark)}/logs-{uuid.uuid4().hex}"
    logs = run_logs(t).select(F.pmod("user_id", F.lit(LOG_FILES)).alias("file"), "run", F.col("log").alias("value"))
    whole = logs.repartition(LOG_FILES, "file").sortWithinPartitions("file", "run").select("file", "value")
    whole.write.partitionBy("file").text(folder)
    return folder


def split_size(t: Tables, folder: str) -> int:
    """Bytes of a split that cuts every log in several: their number doesn't grow with the logs."""
    path = t.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    size = path.getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return min(max(LEAST_SPLIT, size // (LOG_FILES * LOG_SPLITS)), MOST_SPLIT)


def in_small_splits(t: Tables) -> DataFrame:
    size = "spark.sql.files.maxPartitionBytes"
    before = t.spark.conf.get(size)
    folder = log_files(t)
    t.spark.conf.set(size, str(split_size(t, folder)))
    try:  # written while the setting holds
        lines = TableStore(t.spark, f"{folder}-tables").stage("lines", runlog.read_log_lines(t.spark, folder))
    finally:
        t.spark.conf.set(size, before)
    return lines.withColumn("run", F.regexp_extract("run", "file=(\\d+)", 1).cast("bigint"))


@query(
    "run_log_file_failures",
    """SELECT user_id % 20 AS run, 'not_null_orders_error' AS test_name, 'models/error.yml' AS test_resource,
  json_extract_string(props, '$.k') || ' results, configured to fail if != 0' AS result_line,
  'target/' || user_id || '.sql' AS compiled_path, 'not_null' AS test_type FROM events WHERE event_type = 'error'""",
)
def run_log_file_failures(t: Tables) -> DataFrame:
    return runlog.failed_checks_of_lines(in_small_splits(t)).drop("block")


@query(
    "run_log_file_totals",
    """SELECT user_id % 20 AS run, count_if(event_type = 'error') AS n_failed_checks,
  CASE WHEN count_if(event_type = 'error') > 0 THEN 'failed' WHEN arg_min(event_type, event_id) = 'view' THEN 'warned'
  ELSE 'success' END AS state, arg_min(CAST(json_extract_string(props, '$.k') AS BIGINT), event_id) AS n_pass FROM events GROUP BY 1""",
)
def run_log_file_totals(t: Tables) -> DataFrame:
    return runlog.run_totals_of_lines(in_small_splits(t)).select("run", "n_failed_checks", "state", "n_pass")


@query(
    "task_states",
    """SELECT user_id AS run, count_if(event_type = 'view') AS n_success, count_if(event_type = 'error') AS n_failed,
  count_if(event_type = 'click') AS n_upstream_failed FROM events GROUP BY 1""",
)
def task_states(t: Tables) -> DataFrame:
    state = (
        F.when(F.col("event_type") == "view", "success")
        .when(F.col("event_type") == "error", "failed")
        .when(F.col("event_type") == "click", "upstream_failed")
        .otherwise("running")
    )
    return runlog.task_states(t.events.select(F.col("user_id").alias("run"), state.alias("state")))


# orders as they come in, in three steps; each step ends amid the orders of one day, and the stream stops and starts again
@query("stream_by_cursor", "SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders")
def stream_by_cursor(t: Tables) -> DataFrame:
    folder = f"{checkpoint_root(t.spark)}/stream-cursor-{uuid.uuid4().hex}"
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    place, split = F.struct("o_orderdate", "o_orderkey"), {}
    for i, day in enumerate(("1997-03-01", "1999-08-01")):
        same = orders.filter(F.col("o_orderdate") >= F.lit(day).cast("timestamp_ntz"))
        at = same.agg(F.min("o_orderdate").alias("d")).first()["d"]
        keys = same.filter(F.col("o_orderdate") == F.lit(at)).agg(F.expr("percentile_disc(0.5) within group (order by o_orderkey)").alias("k")).first()
        split[i] = F.struct(F.lit(at).cast("timestamp_ntz").alias("o_orderdate"), F.lit(keys["k"]).cast("bigint").alias("o_orderkey"))
    steps = [place <= split[0], (place > split[0]) & (place <= split[1]), place > split[1]]
    for arrived in steps:
        orders.filter(arrived).repartition(3).write.mode("append").parquet(f"{folder}/source")
        stream = read_by_cursor(t.spark, f"{folder}/source", "o_orderdate", "o_orderkey")
        writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/progress").option("path", f"{folder}/sink")
        writer.trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(f"{folder}/sink")


@query(
    "stream_upsert",
    f"SELECT * EXCLUDE (rn) FROM (SELECT *, {NEWEST_EVENT} AS rn FROM events) WHERE rn = 1",
)
def streamed_events(t: Tables) -> DataFrame:
    """The newest event per user and type, kept by a stream over the table's files."""
    folder = f"{checkpoint_root(t.spark)}/stream-upsert-{uuid.uuid4().hex}"
    # written as a pattern, the path may be one file or a folder of files
    stream = t.spark.readStream.schema(t.events.schema).parquet(f"{t.folder}/events.parque[t]")
    store = TableStore(t.spark, f"{folder}/tables")
    stream_upsert(stream, store, "events", ["user_id", "event_type"], ["ts"], f"{folder}/progress").awaitTermination()
    return store.read("events")
