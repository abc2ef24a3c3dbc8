"""All tables in dependency order, each built once from the written tables below it.

A silver or gold table is written when first asked for and read back, so the models
above it start from files: the incident clean-up runs once, not once per report,
and Catalyst knows the true size of every join side.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame

from areaneed.plans import counts, dimensions, facts, reports, staging, tiers, unify
from areaneed.sources.scratch import materialise
from areaneed.sources.writers import write_layer

Save = Callable[[DataFrame, str], DataFrame]

# How the two large tables are clustered; '-' sorts downwards.
CLUSTERED = {
    "int_crimes_unified": ["incident_year", "crime_against", "county_name"],
    "dim_business": ["-is_current", "entity_status", "entity_id"],
}
GOLD = ("dim_", "fct_", "rpt_", "agg_")


def layer_writer(root: str) -> Save:
    """A ``save`` that keeps tables under ``root``, by layer and clustered as declared."""

    def save(df: DataFrame, name: str) -> DataFrame:
        layer = "gold" if name.startswith(GOLD) else "silver"
        return write_layer(df, name, layer, root, CLUSTERED.get(name))

    return save


class Warehouse:
    """Tables by attribute. ``raw`` holds the raw inputs by name:

    incidents_early, incidents_late, income, population, zip_lookup, centroids,
    agency_city, entities (today's register) and history (entity versions). ``save`` writes a table
    and reads it back. ``known`` gives a table as last built, or None: the dimensions keep its keys.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        run_ts: dt.datetime | str,
        save: Save = materialise,
        known: Callable[[str], DataFrame | None] = lambda name: None,
    ):
        self.raw = raw
        self.run_ts = run_ts
        self.save = save
        self.known = known

    # raw layer: staging views
    @cached_property
    def stg_business_entities(self) -> DataFrame:
        return staging.stg_business_entities(self.raw["entities"])

    @cached_property
    def stg_crimes_1997_2015(self) -> DataFrame:
        return staging.stg_crimes_1997_2015(self.raw["incidents_early"])

    @cached_property
    def stg_crimes_2016_2020(self) -> DataFrame:
        return staging.stg_crimes_2016_2020(self.raw["incidents_late"])

    @cached_property
    def stg_income(self) -> DataFrame:
        return staging.stg_income(self.raw["income"])

    @cached_property
    def stg_population(self) -> DataFrame:
        return staging.stg_population(self.raw["population"])

    @cached_property
    def stg_city_county_zip(self) -> DataFrame:
        return self.save(staging.stg_city_county_zip(self.raw["zip_lookup"]), "zip_lookup")

    @cached_property
    def stg_county_boundaries(self) -> DataFrame:
        return staging.stg_county_boundaries(self.raw["centroids"])

    @cached_property
    def stg_snapshot(self) -> DataFrame:
        return staging.stg_snapshot(self.raw["history"])

    # silver layer
    @cached_property
    def int_crimes_unified(self) -> DataFrame:
        rows = unify.int_crimes_unified(
            self.stg_crimes_1997_2015, self.stg_crimes_2016_2020, self.raw["agency_city"]
        )
        return self.save(rows, "int_crimes_unified")

    @cached_property
    def incident_counts(self) -> DataFrame:
        return self.save(counts.incident_counts(self.int_crimes_unified), "incident_counts")

    @cached_property
    def int_income_population(self) -> DataFrame:
        rows = unify.int_income_population(self.stg_income, self.stg_population)
        return self.save(rows, "int_income_population")

    @cached_property
    def crime_tiers(self) -> DataFrame:
        rows = tiers.crime_tiers(counts.of_set(self.incident_counts, "category"))
        return self.save(rows, "crime_tiers")

    @cached_property
    def crime_tier_county_rank(self) -> DataFrame:
        return self.save(tiers.crime_tier_county_rank(self.crime_tiers), "crime_tier_county_rank")

    @cached_property
    def income_tier(self) -> DataFrame:
        return self.save(tiers.income_tier(self.int_income_population), "income_tier")

    @cached_property
    def per_capita_tier(self) -> DataFrame:
        yearly = counts.of_set(self.incident_counts, "year")
        rows = tiers.per_capita_tier(yearly, self.int_income_population)
        return self.save(rows, "per_capita_tier")

    @cached_property
    def final_county_tier_rank(self) -> DataFrame:
        rows = tiers.final_county_tier_rank(
            self.crime_tier_county_rank, self.income_tier, self.per_capita_tier
        )
        return self.save(rows, "final_county_tier_rank")

    # gold layer: dimensions
    @cached_property
    def dim_date(self) -> DataFrame:
        yearly = counts.of_set(self.incident_counts, "year")
        rows = dimensions.dim_date_spanning(yearly, "first_date", "last_date")
        return self.save(rows, "dim_date")

    @cached_property
    def dim_geography(self) -> DataFrame:
        rows = dimensions.dim_geography(
            self.stg_city_county_zip,
            self.stg_county_boundaries,
            known=self.known("dim_geography"),
        )
        return self.save(rows, "dim_geography")

    @cached_property
    def dim_offense(self) -> DataFrame:
        offenses = counts.of_set(self.incident_counts, "offense")
        rows = dimensions.dim_offense(offenses, self.known("dim_offense"))
        return self.save(rows, "dim_offense")

    @cached_property
    def dim_agency(self) -> DataFrame:
        agencies = counts.of_set(self.incident_counts, "agency")
        rows = dimensions.dim_agency(agencies, self.known("dim_agency"))
        return self.save(rows, "dim_agency")

    @cached_property
    def dim_business(self) -> DataFrame:
        rows = dimensions.dim_business(self.stg_snapshot, self.stg_city_county_zip, self.run_ts)
        return self.save(rows, "dim_business")

    # gold layer: facts
    @cached_property
    def fct_crimes(self) -> DataFrame:
        rows = facts.fct_crimes(
            self.int_crimes_unified,
            self.dim_date,
            self.dim_agency,
            self.dim_offense,
            self.dim_geography,
        )
        return self.save(rows, "fct_crimes")

    @cached_property
    def fact_counts(self) -> DataFrame:
        return self.save(counts.fact_counts(self.fct_crimes, self.dim_offense), "fact_counts")

    @cached_property
    def fct_income_population(self) -> DataFrame:
        rows = facts.fct_income_population(self.int_income_population, self.dim_geography)
        return self.save(rows, "fct_income_population")

    @cached_property
    def fct_business_subsidy_tiers(self) -> DataFrame:
        rows = facts.fct_business_subsidy_tiers(
            self.dim_business, self.final_county_tier_rank, self.dim_geography
        )
        return self.save(rows, "fct_business_subsidy_tiers")

    # gold layer: reports
    @cached_property
    def rpt_business_tier_lookup(self) -> DataFrame:
        rows = reports.rpt_business_tier_lookup(self.fct_business_subsidy_tiers)
        return self.save(rows, "rpt_business_tier_lookup")

    @cached_property
    def rpt_agency_baseline(self) -> DataFrame:
        rows = reports.rpt_agency_baseline(self.fct_crimes, self.dim_agency)
        return self.save(rows, "rpt_agency_baseline")

    @cached_property
    def rpt_city_demographics(self) -> DataFrame:
        rows = reports.rpt_city_demographics(
            self.fct_crimes, self.dim_geography, self.dim_offense
        )
        return self.save(rows, "rpt_city_demographics")

    @cached_property
    def rpt_city_time_of_day(self) -> DataFrame:
        rows = reports.rpt_city_time_of_day(self.fct_crimes, self.dim_geography, self.dim_offense)
        return self.save(rows, "rpt_city_time_of_day")

    @cached_property
    def rpt_city_time_trends(self) -> DataFrame:
        rows = reports.rpt_city_time_trends(self.fct_crimes, self.dim_geography, self.dim_date)
        return self.save(rows, "rpt_city_time_trends")

    def tables(self, *names: str) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in names}

    def metric_inputs(self) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
        """Facts and dimensions under the names the metric layer uses."""
        fact_names = {
            "crimes": "fct_crimes",
            "income_population": "fct_income_population",
            "business": "fct_business_subsidy_tiers",
            "agency_baseline": "rpt_agency_baseline",
        }
        dim_names = {
            "geography": "dim_geography",
            "date": "dim_date",
            "offense": "dim_offense",
            "agency": "dim_agency",
        }
        return (
            {k: getattr(self, v) for k, v in fact_names.items()},
            {k: getattr(self, v) for k, v in dim_names.items()},
        )
