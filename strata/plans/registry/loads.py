"""Sources, landing and publishing over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.contract import LoadSpec, check_load_contract, load_mode_violations
from strata.plans import bronze
from strata.plans.bronze import Tables
from strata.plans.registry.base import RUN_TS, TS, query
from strata.sources.landing import merge_watermarks, stamp_bronze
from strata.sources.publish import PublishSpec, capped, publication_scope, to_records
from strata.sources.readers import SourceSpec, explode_records, read_source


@query(
    "source_extract",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'",
)
def source_extract(t: Tables) -> DataFrame:
    spec = SourceSpec(
        "orders",
        path=f"{t.folder}/orders.parquet",
        columns=["o_orderkey", "o_custkey", "o_totalprice"],
        cursor="o_orderdate",
        last_value="1998-01-01",
    )
    return read_source(t.spark, spec)


@query(
    "stamp_bronze",
    f"""SELECT *, md5(CAST(c_custkey AS VARCHAR) || '|' || c_name) AS _airbyte_raw_id, {TS} AS _airbyte_extracted_at,
  '{{}}' AS _airbyte_meta FROM customer""",
)
def stamped(t: Tables) -> DataFrame:
    return stamp_bronze(t.customer, RUN_TS, id_from=["c_custkey", "c_name"])


# one API response per event, its records under "value"
@query(
    "json_records",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def json_records(t: Tables) -> DataFrame:
    payload = F.concat(F.lit('{"value": ['), "props", F.lit("]}"))
    responses = t.events.select("event_id", payload.alias("body"))
    return explode_records(responses, "body", T.StructType([T.StructField("k", T.LongType())]), "value")


@query(
    "load_contract",
    """SELECT 'lineitem' AS stream, 'key unique' AS rule, count(*) AS failing_rows
FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) HAVING count(*) > 0
UNION ALL SELECT 'lineitem', 'cursor not null', count(*) FROM lineitem WHERE l_returnflag = 'R' HAVING count(*) > 0
UNION ALL SELECT 'lineitem', 'column l_comment present', 1
UNION ALL SELECT 'lineitem', 'high water not going back', 1 FROM lineitem
  HAVING max(l_shipdate) < TIMESTAMP '2030-01-01'""",
)
def load_contract(t: Tables) -> DataFrame:
    # returned lines lack a ship date, so that there is something to find
    landed = t.lineitem.withColumn("l_shipdate", F.when(F.col("l_returnflag") != "R", F.col("l_shipdate")))
    spec = LoadSpec("lineitem", ["l_orderkey", "l_linenumber"], "l_shipdate", columns=["l_partkey", "l_comment"])
    return check_load_contract(landed, spec, last_high_water="2030-01-01")


# one stream per customer: declared by its segment, configured by its balance
@query(
    "load_modes",
    """WITH m AS (SELECT c_name AS stream,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'full_refresh' ELSE 'incremental' END AS d_mode,
  CASE WHEN c_acctbal < 0 THEN 'full_refresh' ELSE 'incremental' END AS c_mode,
  CASE WHEN c_nationkey > 20 THEN 'id' ELSE 'id,line' END AS c_key FROM customer)
SELECT stream, 'sync_mode' AS rule, d_mode AS declared, c_mode AS configured FROM m WHERE d_mode <> c_mode
UNION ALL SELECT stream, 'primary_key', 'id,line', c_key FROM m WHERE c_key <> 'id,line'""",
)
def load_modes(t: Tables) -> DataFrame:
    def specs(mode, keys):
        return t.customer.select(
            F.col("c_name").alias("stream"),
            mode.alias("sync_mode"),
            F.lit("append_dedup").alias("destination_mode"),
            F.lit(None).cast("string").alias("cursor"),
            keys.alias("primary_key"),
        )

    def either(condition):
        return F.when(condition, "full_refresh").otherwise("incremental")

    whole = F.array(F.lit("line"), F.lit("id"))
    declared = specs(either(F.col("c_mktsegment") == "BUILDING"), whole)
    part = F.when(F.col("c_nationkey") > 20, F.array(F.lit("id"))).otherwise(F.array(F.lit("id"), F.lit("line")))
    return load_mode_violations(declared, specs(either(F.col("c_acctbal") < 0), part))


WATERMARKS = """SELECT event_type AS bronze_schema, 'c-' || event_type AS connection_id, max(ts) AS synced_at,
  max(event_id) AS job_id, count(*) AS records_emitted, count(*) - count_if(value < 1) AS records_committed
  FROM events WHERE {where} GROUP BY event_type"""


def watermarks(events: DataFrame) -> DataFrame:
    """One sync log row per event type."""
    return events.groupBy(F.col("event_type").alias("bronze_schema")).agg(
        F.concat(F.lit("c-"), F.max("event_type")).alias("connection_id"),
        F.max("ts").alias("synced_at"),
        F.max("event_id").alias("job_id"),
        F.count(F.lit(1)).alias("records_emitted"),
        (F.count(F.lit(1)) - F.count_if(F.col("value") < 1)).alias("records_committed"),
    )


@query(
    "record_watermark",
    f"""WITH s AS ({WATERMARKS.format(where="ts < TIMESTAMP '2024-01-20'")}),
b AS ({WATERMARKS.format(where="ts >= TIMESTAMP '2024-01-20' AND event_type <> 'error'")})
SELECT * FROM s WHERE bronze_schema NOT IN (SELECT bronze_schema FROM b) UNION ALL SELECT * FROM b""",
)
def record_watermark(t: Tables) -> DataFrame:
    cut = F.lit("2024-01-20").cast("timestamp_ntz")
    before = watermarks(t.events.filter(F.col("ts") < cut))
    return merge_watermarks(before, watermarks(t.events.filter((F.col("ts") >= cut) & (F.col("event_type") != "error"))))


# ---- publishing


@query("publish_capped", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 2000")
def publish_capped(t: Tables) -> DataFrame:
    return capped(t.orders, PublishSpec("orders", ("o_orderkey",), max_rows=2000))


# a composite key and a cap above the number of rows that a plain top-k should sort
@query(
    "publish_capped_large",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM (SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity
  FROM lineitem GROUP BY 1, 2) ORDER BY l_orderkey, l_linenumber LIMIT 20000""",
)
def publish_capped_large(t: Tables) -> DataFrame:
    lines = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("l_quantity"))
    return capped(lines, PublishSpec("lines", ("l_orderkey", "l_linenumber"), max_rows=20_000))


@query(
    "publish_records",
    """SELECT id, customer_id, CAST(amount AS DOUBLE) AS amount, strftime(order_date, '%Y-%m-%dT%H:%M:%S') AS order_date,
  strftime(CAST(order_date AS DATE), '%Y-%m-%d') AS order_day, status, strftime(order_date, '%Y-%m-%dT%H:%M:%S')
  AS _airbyte_extracted_at FROM (SELECT o_orderkey AS id, o_custkey AS customer_id, o_totalprice AS amount,
  o_orderdate AS order_date, o_orderstatus AS status FROM orders)""",
)
def publish_records(t: Tables) -> DataFrame:
    rows = bronze.orders(t).withColumn("order_day", F.col("order_date").cast("date"))
    return to_records(rows)


@query(
    "publication_scope",
    """SELECT 'gold.customers' AS warehouse_source, least(count(*), 1000) AS published_rows,
  CAST(1000 AS BIGINT) AS publish_limit, count(*) >= 1000 AS is_capped FROM customer""",
)
def scope(t: Tables) -> DataFrame:
    spec = PublishSpec("customer", ("c_custkey",), max_rows=1000)
    return publication_scope(capped(t.customer, spec), spec.max_rows, "gold.customers")
