"""Country reference from an API feed: full refresh every run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import columns as names
from strata.functions.text import blank_to_null, norm
from strata.functions.time import as_instant, utc_literal
from strata.operators.conform import conform, require_not_null, with_run_ts
from strata.operators.dedupe import first_per_key
from strata.operators.quality import Check, checks_for
from strata.plans.common import Report, finish, job, load, pass_gate, publish_all, require_fresh
from strata.sources.landing import WATERMARKS, Sync
from strata.sources.publish import PublishSpec
from strata.sources.store import TableStore

BRONZE, SILVER, GOLD = "src_api_countries", "silver_api", "gold_api"

# What is published of this pipeline.
PUBLICATIONS = [PublishSpec("dim_country", ("country_id",))]

# The status pair of an active country.
ACTIVE_STATE, ACTIVE_STATUS = 0, 1


def stg_countries(bronze: DataFrame, run_ts: datetime) -> DataFrame:
    """One row per country code: the longest name wins, then the latest load.

    Countries are first reduced to one row per id. Descending orders put NULL first here, so a missing
    name or load time wins; all rows without a code collapse into one.
    """
    clean = conform(
        require_not_null(bronze, ["countryid"]),
        {
            "country_id": norm("countryid"),
            "country_code": norm("countrycode", "upper"),
            "country_name": norm("country"),
            "import_sequence_number": blank_to_null("importsequencenumber", "bigint"),
            "state_code": blank_to_null("statecode", "smallint"),
            "status_code": blank_to_null("statuscode", "smallint"),
            "bronze_loaded_at": as_instant(names.EXTRACTED_AT),
        },
    )
    loaded = F.col("bronze_loaded_at").desc_nulls_first()
    per_id = first_per_key(clean, ["country_id"], [loaded])
    longest = F.length("country_name").desc_nulls_first()
    # rebuilt from the raw table every run, so no key can be left over to prune
    return with_run_ts(first_per_key(per_id, ["country_code"], [longest, loaded]), run_ts)


def dim_country(countries: DataFrame, run_ts: datetime) -> DataFrame:
    """Countries with their activity flag (unknown when a status is missing and none rules it out)."""
    active = (F.col("state_code") == ACTIVE_STATE) & (F.col("status_code") == ACTIVE_STATUS)
    return countries.select(
        "country_id",
        "country_code",
        "country_name",
        "import_sequence_number",
        "state_code",
        "status_code",
        active.alias("is_active"),
        F.col("bronze_loaded_at").alias("last_loaded_at"),
        utc_literal(run_ts).alias(names.BUILT_AT),
    )


def silver_checks(bronze: DataFrame, countries: DataFrame) -> list[Check]:
    return [
        *checks_for(
            "source_countries", bronze, not_null=["countryid", "countrycode", "country"], unique=["countryid"]
        ),
        *checks_for(
            "stg_countries",
            countries,
            not_null=["country_id", "country_code", "country_name"],
            unique=["country_id", "country_code"],
        ),
    ]


def gold_checks(dim: DataFrame) -> list[Check]:
    keys = ["country_id", "country_code"]
    return checks_for("dim_country", dim, not_null=keys, unique=keys)


@job
def run_countries(
    bronze: DataFrame,
    store: TableStore,
    run_ts: datetime,
    watermarks: DataFrame | None = None,
    publications: list[PublishSpec] = PUBLICATIONS,
    keep_failures: bool = True,
    load_sources: bool = False,
    catalog: bool = False,
) -> Report:
    """Load (with ``load_sources``), freshness, Silver, Silver gate, Gold, Gold gate, publish, finish. Both layers are
    built anew by each run, so no row can be late."""
    report = Report()
    if load_sources:
        bronze = load(store, BRONZE, {"countries": bronze}, {"countries": Sync()}, run_ts, report)["countries"]
        watermarks = store.read(WATERMARKS)
    require_fresh(watermarks, BRONZE, run_ts, report)
    countries = store.overwrite(f"{SILVER}/stg_countries", stg_countries(bronze, run_ts), ["country_id"])
    report.stages.append("silver")
    pass_gate("silver gate", silver_checks(bronze, countries), report, store, run_ts, keep_failures)
    dim = store.overwrite(f"{GOLD}/dim_country", dim_country(countries, run_ts), ["country_id"])
    report.stages.append("gold")
    pass_gate("gold gate", gold_checks(dim), report, store, run_ts, keep_failures)
    publish_all(store, GOLD, publications, report)
    finish(store, report, {f"{GOLD}/dim_country": ["country_id"]} if catalog else None)
    return report
