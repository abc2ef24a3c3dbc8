"""The declared checks of every table, run with one pass per table.

Uniqueness needs a count per value and is run as a query of its own.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaneed.constants import CRIME_AGAINST, EARLY_PERIOD, HOME_STATE, LATE_PERIOD
from areaneed.operators.quality import (
    accepted_values,
    between,
    dq_one_current_version,
    dq_orphan_keys,
    dq_rows,
    dq_tier_bounds,
    dq_unique,
    not_null,
)

SEASONS = ["winter", "spring", "summer", "fall"]
DAY_PARTS = ["day", "night"]


def _all(*groups: dict[str, Column]) -> dict[str, Column]:
    return {name: cond for group in groups for name, cond in group.items()}


def declared_checks() -> dict[str, dict[str, Column]]:
    """Table -> check name -> condition that a failing row meets.

    Built on call, since a Column needs a running session.
    """
    tier = [1, 2, 3, 4]
    return {
        "stg_business_entities": not_null(
            ["entity_id", "entity_name", "principal_state", "entity_form_date"]
        ),
        "stg_crimes_1997_2015": not_null(
            ["agency_name", "county_name", "incident_date", "offense_category_name"]
        ),
        "stg_crimes_2016_2020": not_null(
            ["agency_name", "county_name", "incident_date", "offense_category_name"]
        ),
        "stg_income": not_null(["county", "year", "income"]),
        "stg_population": _all(
            not_null(["county", "year", "total_population"]), between("total_population", 0)
        ),
        "int_crimes_unified": _all(
            not_null(
                [
                    "agency_name", "county_name", "incident_date", "offense_name",
                    "crime_against", "offense_category_name", "source_period",
                    "incident_year", "incident_month", "day_of_week", "time_of_day", "season",
                ]
            ),
            between("incident_hour", 0, 23),
            between("age_num", 0, 120),
            between("incident_month", 1, 12),
            between("day_of_week", 1, 7),
            accepted_values("crime_against", CRIME_AGAINST),
            accepted_values("source_period", [EARLY_PERIOD, LATE_PERIOD]),
            accepted_values("time_of_day", DAY_PARTS),
            accepted_values("season", SEASONS),
        ),
        "int_income_population": _all(
            not_null(["county", "year"]), between("total_population", 1)
        ),
        "crime_tiers": _all(
            not_null(
                ["county_name", "offense_category_name", "total_crimes", "crime_percentile",
                 "crime_tier"]
            ),
            between("crime_percentile", 0, 1),
            accepted_values("crime_tier", tier),
        ),
        "crime_tier_county_rank": _all(
            not_null(["county_name", "overall_crime_tier"]), between("overall_crime_tier", 1, 4)
        ),
        "income_tier": _all(
            not_null(["county", "avg_median_household_income", "income_percentile",
                      "income_tier"]),
            between("income_percentile", 0, 1),
            accepted_values("income_tier", tier),
        ),
        "per_capita_tier": _all(
            not_null(["county", "avg_crime_per_1000", "crime_percentile",
                      "crime_per_capita_tier"]),
            between("crime_percentile", 0, 1),
            accepted_values("crime_per_capita_tier", tier),
        ),
        "final_county_tier_rank": _all(
            not_null(["county", "crime_rank", "income_rank", "population_rank", "final_rank"]),
            between("crime_rank", 0, 4),
            between("income_rank", 0, 4),
            between("population_rank", 0, 4),
            between("final_rank", 1, 4),
        ),
        "dim_date": _all(
            not_null(["date_key", "full_date", "year", "quarter", "month", "day_of_week",
                      "season"]),
            between("month", 1, 12),
            between("day_of_week", 1, 7),
            accepted_values("season", SEASONS),
        ),
        "dim_geography": _all(
            not_null(["geo_key", "city_name", "county_name", "state"]),
            accepted_values("state", [HOME_STATE]),
        ),
        "dim_offense": _all(
            not_null(["offense_key", "offense_category_name", "crime_against"]),
            accepted_values("crime_against", CRIME_AGAINST),
        ),
        "dim_agency": not_null(["agency_key", "agency_name", "primary_county"]),
        "dim_business": not_null(
            ["business_key", "entity_id", "entity_name", "entity_status", "is_current",
             "business_scd_id"]
        ),
        "fct_crimes": _all(
            not_null(["date_key", "geo_key", "offense_key", "incident_date", "time_of_day",
                      "crime_count"]),
            accepted_values("time_of_day", DAY_PARTS),
            between("crime_count", 1, 1),
        ),
        "fct_income_population": _all(
            not_null(["geo_key", "year", "total_population"]), between("total_population", 1)
        ),
        "fct_business_subsidy_tiers": _all(
            not_null(["business_key", "entity_id", "composite_tier", "qualifies_for_subsidy",
                      "subsidy_tier_label", "notification_eligible"]),
            between("composite_tier", 1, 4),
        ),
        "rpt_agency_baseline": not_null(
            ["county_name", "agency_name", "total_crimes", "target_crimes_5pct_reduction",
             "first_incident_date", "last_incident_date"]
        ),
        "rpt_business_tier_lookup": _all(
            not_null(["entity_id", "entity_name", "principal_county", "composite_tier",
                      "qualifies_for_subsidy", "notification_eligible", "subsidy_message"]),
            between("composite_tier", 1, 4),
        ),
        "rpt_city_time_trends": _all(
            not_null(["city_name", "county_name", "month", "month_name", "season",
                      "day_of_week", "day_name", "total_crimes"]),
            accepted_values("season", SEASONS),
        ),
        "rpt_city_time_of_day": _all(
            not_null(["city_name", "county_name", "time_of_day", "offense_category_name",
                      "crime_against", "crime_count", "rnk"]),
            accepted_values("time_of_day", DAY_PARTS),
            accepted_values("crime_against", CRIME_AGAINST),
            accepted_values("rnk", [1, 2, 3]),
        ),
        "rpt_city_demographics": _all(
            not_null(["city_name", "county_name", "offense_category_name", "crime_against"]),
            accepted_values("crime_against", CRIME_AGAINST),
        ),
    }


# Columns declared unique.
UNIQUE_COLUMNS = {
    "stg_business_entities": ["entity_id"],
    "stg_city_county_zip": ["zip_code"],
    "crime_tier_county_rank": ["county_name"],
    "income_tier": ["county"],
    "per_capita_tier": ["county"],
    "final_county_tier_rank": ["county"],
    "dim_date": ["date_key", "full_date"],
    "dim_geography": ["geo_key"],
    "dim_offense": ["offense_key"],
    "dim_agency": ["agency_key", "agency_name"],
    "dim_business": ["business_key", "business_scd_id"],
    "fct_business_subsidy_tiers": ["business_key", "entity_id"],
    "rpt_business_tier_lookup": ["entity_id"],
}


def run_row_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every declared row check of the given tables, one pass over each."""
    results = [
        dq_rows(tables[name], checks).select(F.lit(name).alias("table"), "check", "failing_rows")
        for name, checks in declared_checks().items()
        if name in tables
    ]
    return reduce(DataFrame.unionByName, results)


def run_unique_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every declared uniqueness check of the given tables."""
    results = [
        dq_unique(tables[name], cols).select(F.lit(name).alias("table"), "check", "failing_rows")
        for name, cols in UNIQUE_COLUMNS.items()
        if name in tables
    ]
    return reduce(DataFrame.unionByName, results)


def run_invariants(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The three table-level rules: versions, tier bounds, orphan keys."""
    results = [
        ("dim_business", dq_one_current_version(tables["dim_business"], "entity_id", "is_current")),
        (
            "fct_business_subsidy_tiers",
            dq_tier_bounds(tables["fct_business_subsidy_tiers"], "composite_tier"),
        ),
        ("fct_crimes", dq_orphan_keys(tables["fct_crimes"], tables["dim_geography"], "geo_key")),
    ]
    return reduce(
        DataFrame.unionByName,
        [df.select(F.lit(name).alias("table"), "check", "failing_rows") for name, df in results],
    )
