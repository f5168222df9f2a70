"""Data-quality checks over the test tables, with breaks put in where the data has none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import incremental, quality
from strata.operators.joins import orphans
from strata.operators.quality import checks_for, run_checks
from strata.plans import bronze
from strata.plans.bronze import Tables
from strata.plans.registry.base import query
from strata.sources.generate import is_drill_row

RICH = "SELECT c_custkey FROM customer WHERE c_acctbal >= 0"


def known_customers(t: Tables) -> DataFrame:
    """The parent table after customers in debt were removed: their orders are orphans."""
    return t.customer.filter("c_acctbal >= 0")


def anonymous_orders(t: Tables) -> DataFrame:
    """Orders of which finished ones have lost their customer."""
    return t.orders.withColumn("o_custkey", F.when(F.col("o_orderstatus") != "F", F.col("o_custkey")))


ANONYMOUS = "a AS (SELECT * REPLACE (CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS o_custkey) FROM orders)"


@query("dq_not_null", f"WITH {ANONYMOUS} SELECT * FROM a WHERE o_custkey IS NULL")
def dq_not_null(t: Tables) -> DataFrame:
    return quality.not_null(anonymous_orders(t), "o_custkey")


@query(
    "dq_unique",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def dq_unique(t: Tables) -> DataFrame:
    return quality.unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "dq_relationships",
    f"""WITH {ANONYMOUS} SELECT o_custkey, count(*) AS n_rows FROM a
WHERE o_custkey IS NOT NULL AND o_custkey NOT IN ({RICH}) GROUP BY 1""",
)
def dq_relationships(t: Tables) -> DataFrame:
    return quality.relationships(anonymous_orders(t), "o_custkey", known_customers(t), "c_custkey")


@query("dq_accepted_range", "SELECT * FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000")
def dq_accepted_range(t: Tables) -> DataFrame:
    return quality.accepted_range(t.customer, "c_acctbal", 0, 9000)


@query(
    "dq_orphan_rule",
    f"""WITH {ANONYMOUS} SELECT o_orderkey, o_custkey FROM a
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0)""",
)
def dq_orphan_rule(t: Tables) -> DataFrame:
    child = anonymous_orders(t).select("o_orderkey", "o_custkey")
    return quality.rule(orphans(child, known_customers(t), {"o_custkey": "c_custkey"}))


@query(
    "dq_suite",
    f"""WITH {ANONYMOUS}
SELECT 'not_null_orders_o_custkey' AS check_name, count(*) AS failing_rows FROM a WHERE o_custkey IS NULL
UNION ALL SELECT 'not_null_orders_o_orderkey', count(*) FROM a WHERE o_orderkey IS NULL
UNION ALL SELECT 'unique_orders_o_custkey', count(*) FROM
  (SELECT 1 FROM a WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1)
UNION ALL SELECT 'unique_orders_o_orderkey', count(*) - count(DISTINCT o_orderkey) FROM a
UNION ALL SELECT 'relationships_orders_o_custkey', count(*) FROM a
  WHERE o_custkey IS NOT NULL AND o_custkey NOT IN ({RICH})
UNION ALL SELECT 'accepted_range_orders_o_totalprice', count(*) FROM a WHERE NOT (o_totalprice >= 2000)
UNION ALL SELECT 'not_null_customer_c_name', count(*) FROM customer WHERE c_name IS NULL
UNION ALL SELECT 'accepted_range_customer_c_acctbal', count(*) FROM customer WHERE NOT (c_acctbal >= 0)""",
)
def dq_suite(t: Tables) -> DataFrame:
    orders = checks_for(
        "orders",
        anonymous_orders(t),
        not_null=["o_custkey", "o_orderkey"],
        unique=["o_custkey", "o_orderkey"],
        relationships={"o_custkey": (known_customers(t), "c_custkey")},
        ranges={"o_totalprice": (2000, None)},
    )
    customers = checks_for("customer", t.customer, not_null=["c_name"], ranges={"c_acctbal": (0, None)})
    return run_checks([*orders, *customers])


def bad_customers(t: Tables) -> DataFrame:
    return quality.relationships(t.orders, "o_custkey", known_customers(t), "c_custkey")


@query("quarantine_good", f"SELECT * FROM orders WHERE o_custkey IN ({RICH})")
def quarantine_good(t: Tables) -> DataFrame:
    return quality.quarantine(t.orders, bad_customers(t), "o_custkey")[0]


@query("quarantine_bad", f"SELECT * FROM orders WHERE o_custkey NOT IN ({RICH})")
def quarantine_bad(t: Tables) -> DataFrame:
    return quality.quarantine(t.orders, bad_customers(t), "o_custkey")[1]


@query("violation_preview", "SELECT * FROM customer WHERE c_acctbal < 0 ORDER BY c_custkey LIMIT 5")
def violation_preview(t: Tables) -> DataFrame:
    return quality.preview(quality.accepted_range(t.customer, "c_acctbal", 0), order=["c_custkey"])


# every customer's email is given out once more, orders come from nowhere; both are taken out again
DRILL = """
c AS (SELECT c_custkey AS id, lower(c_name) || '@example.com' AS email FROM customer
  UNION ALL SELECT c_custkey + 900000000, lower(c_name) || '@example.com' FROM customer WHERE c_acctbal < 0),
o AS (SELECT o_orderkey AS id, o_custkey AS customer_id, o_orderstatus AS status FROM orders
  UNION ALL SELECT o_orderkey + 900000000, o_custkey + 2000000000, 'BAD_DATA_DRILL_ORPHAN' FROM orders
  WHERE o_orderstatus = 'P')"""


@query(
    "bad_data_drill",
    f"""WITH {DRILL}
SELECT 'unique_customers_email' AS check_name, count(*) AS failing_rows FROM
  (SELECT 1 FROM c GROUP BY email HAVING count(*) > 1)
UNION ALL SELECT 'relationships_orders_customer_id', count(*) FROM o WHERE customer_id NOT IN (SELECT id FROM c)""",
)
def bad_data_drill(t: Tables) -> DataFrame:
    customers, orders = _drilled(t)
    return run_checks(
        [
            *checks_for("customers", customers, unique=["email"]),
            *checks_for("orders", orders, relationships={"customer_id": (customers, "id")}),
        ]
    )


@query("bad_data_reverted", f"WITH {DRILL} SELECT * FROM o WHERE NOT (id >= 900000000 OR status LIKE 'BAD_DATA_DRILL%')")
def bad_data_reverted(t: Tables) -> DataFrame:
    return incremental.delete_where(_drilled(t)[1], is_drill_row("id", "status"))


def _drilled(t: Tables) -> tuple[DataFrame, DataFrame]:
    email = F.lower(F.trim("email")).alias("email")
    customers = bronze.customers(t).select("id", email)
    doubles = t.customer.filter("c_acctbal < 0").select(
        (F.col("c_custkey") + 900_000_000).alias("id"), F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email")
    )
    orders = bronze.orders(t).select("id", "customer_id", "status")
    strays = orders.filter("status = 'P'").select(
        (F.col("id") + 900_000_000).alias("id"),
        (F.col("customer_id") + 2_000_000_000).alias("customer_id"),
        F.lit("BAD_DATA_DRILL_ORPHAN").alias("status"),
    )
    return incremental.upsert(customers, doubles, ["id"]), incremental.upsert(orders, strays, ["id"])
