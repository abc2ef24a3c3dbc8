"""One run from a landed day of the register to gold, every table through the gate.

A breach stops the run where it happens; tables already published by the run stay, and the broken
one and those above it remain as the last good run left them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaneed.operators.quality import (
    dq_freshness,
    dq_one_current_version,
    dq_orphan_keys,
    dq_tier_bounds,
)
from areaneed.plans.checks import UNIQUE_COLUMNS, declared_checks
from areaneed.plans.daily import run_day
from areaneed.plans.warehouse import Save, Warehouse
from areaneed.sources.gate import BrokenContract, Check, publish, published
from areaneed.sources.schemas import CONTRACTS
from areaneed.sources.versions import read_version

#: In the order in which they are built.
TABLES = [
    "int_crimes_unified",
    "incident_counts",
    "int_income_population",
    "crime_tiers",
    "crime_tier_county_rank",
    "income_tier",
    "per_capita_tier",
    "final_county_tier_rank",
    "dim_date",
    "dim_geography",
    "dim_offense",
    "dim_agency",
    "dim_business",
    "fct_crimes",
    "fact_counts",
    "fct_income_population",
    "fct_business_subsidy_tiers",
    "rpt_agency_baseline",
    "rpt_business_tier_lookup",
    "rpt_city_demographics",
    "rpt_city_time_of_day",
    "rpt_city_time_trends",
]


def table_checks(root: str) -> dict[str, list[Check]]:
    """The table-level rules: versions, tier bounds, keys without a dimension row."""

    def orphans(rows: DataFrame) -> DataFrame:
        places = published(rows.sparkSession, root, "dim_geography")
        return dq_orphan_keys(rows, places, "geo_key")

    return {
        "dim_business": [lambda rows: dq_one_current_version(rows, "entity_id", "is_current")],
        "fct_business_subsidy_tiers": [lambda rows: dq_tier_bounds(rows, "composite_tier")],
        "fct_crimes": [orphans],
    }


def gated_writer(root: str) -> Save:
    """A ``save`` that publishes a table under ``root`` only if it keeps all that is declared of it."""
    rules, checks = declared_checks(), table_checks(root)

    def save(df: DataFrame, name: str) -> DataFrame:
        return publish(
            df,
            root,
            name,
            CONTRACTS.get(name),
            rules.get(name),
            UNIQUE_COLUMNS.get(name, ()),
            checks.get(name, ()),
        )

    return save


def build_gold(raw: Mapping[str, DataFrame], run_ts: dt.datetime | str, root: str) -> Warehouse:
    """Build and publish every table; ``BrokenContract`` stops at the first that fails. Dimension rows
    keep the keys they were last published with, so facts of earlier runs still point to them."""
    spark = raw["history"].sparkSession

    def known(name: str) -> DataFrame | None:
        return published(spark, root, name)

    warehouse = Warehouse(raw, run_ts, gated_writer(root), known)
    for name in TABLES:
        getattr(warehouse, name)
    return warehouse


def run_to_gold(
    spark: SparkSession,
    extract: DataFrame,
    raw: Mapping[str, DataFrame],
    root: str,
    day: dt.date,
    ingested_at: dt.datetime,
) -> Warehouse:
    """Land a day of the register, check that it is fresh, merge and version it, and build gold.

    ``raw`` holds the other raw inputs of ``Warehouse``. The run's time is ``ingested_at``; a landed
    day whose rows are older than the error limit of ``dq_freshness`` stops the run.
    """
    history = run_day(spark, extract, f"{root}/register", day, ingested_at)
    register = read_version(spark, f"{root}/register/register")
    landed = spark.read.parquet(f"{root}/register/landed")
    fresh = dq_freshness(landed.where(F.col("source_date") == day), "_ingested_at", ingested_at)
    if late := [r["check"] for r in fresh.where("failing_rows > 0").collect()]:
        raise BrokenContract("landed", dict.fromkeys(late, 1))
    return build_gold({**raw, "entities": register, "history": history}, ingested_at, f"{root}/gold")
