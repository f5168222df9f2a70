"""All named queries over the test tables, each with its SQL counterpart where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.plans.bronze import Tables
from strata.plans.registry import aggregates, functions, incremental, jobs, loads, lookups, models, monitoring, quality, stored
from strata.plans.registry.base import ENTRIES, plain

_ = (aggregates, functions, incremental, jobs, loads, lookups, models, monitoring, quality, stored)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        return lambda spark, folder: plain(build(Tables(spark, folder)))

    return {name: bind(build) for name, (build, _) in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ENTRIES.items() if sql}
