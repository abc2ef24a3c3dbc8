"""The three facts of the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaneed.constants import COUNTY_LEVEL, QUALIFYING_TIER, UNKNOWN
from areaneed.functions.scores import tier_label
from areaneed.functions.text import clean_key, first_listed_county
from areaneed.operators.joins import lookup_left


def county_keys(geo: DataFrame) -> DataFrame:
    """The county-level row of each county: county, geo_key."""
    return geo.where(F.col("city_name") == COUNTY_LEVEL).select(
        clean_key(F.col("county_name")).alias("county"), "geo_key"
    )


def city_keys(geo: DataFrame) -> DataFrame:
    """One row per county and city; of a city's zip rows the lowest key stands for it."""
    return (
        geo.where(F.col("city_name") != COUNTY_LEVEL)
        .groupBy(
            clean_key(F.col("county_name")).alias("county"),
            clean_key(F.col("city_name")).alias("city"),
        )
        .agg(F.min("geo_key").alias("city_geo_key"))
    )


def fct_crimes(
    incidents: DataFrame, date: DataFrame, agency: DataFrame, offense: DataFrame, geo: DataFrame
) -> DataFrame:
    """One row per incident with its dimension keys.

    Each dimension is unique on its join key, so the fact has exactly as many rows as
    ``incidents``. Written dimensions below the broadcast threshold join without a
    shuffle; an agency list above it is joined by sort-merge, where AQE splits an
    agency that holds a large part of the incidents.
    """
    rows = incidents.select(
        "incident_date",
        "incident_hour",
        "time_of_day",
        "age_num",
        "source_period",
        "agency_name",
        "offense_category_name",
        "offense_name",
        "crime_against",
        F.coalesce("offense_group", F.lit(UNKNOWN)).alias("offense_group"),
        first_listed_county(F.col("county_name")).alias("county"),
        clean_key(F.col("city_name")).alias("city"),
    )
    days = date.select(F.col("date_day").alias("incident_date"), "date_key")
    offense_cols = ["offense_category_name", "offense_name", "crime_against", "offense_group"]
    return (
        rows.join(days, "incident_date", "left")
        .join(offense.select(*offense_cols, "offense_key"), offense_cols, "left")
        .join(county_keys(geo), "county", "left")
        .join(city_keys(geo), ["county", "city"], "left")
        .join(agency.select("agency_name", "agency_key"), "agency_name", "left")
        .select(
            "incident_date",
            "incident_hour",
            "time_of_day",
            "age_num",
            "source_period",
            "date_key",
            "geo_key",
            "city_geo_key",
            "offense_key",
            "agency_key",
            F.lit(1).alias("crime_count"),
        )
    )


def fct_income_population(income_population: DataFrame, geo: DataFrame) -> DataFrame:
    """County-year rows with the county key and a January 1 date."""
    keyed = income_population.join(
        county_keys(geo).withColumnRenamed("county", "county_normalized"),
        "county_normalized",
        "left",
    )
    return keyed.select(
        "geo_key",
        "year",
        F.make_date("year", F.lit(1), F.lit(1)).alias("year_date"),
        "median_household_income",
        "per_capita_income",
        "total_personal_income",
        "total_population",
        "male_population",
        "female_population",
        "population_yoy_change",
        "population_growth_pct",
    )


def fct_business_subsidy_tiers(
    business: DataFrame,
    tiers: DataFrame,
    geo: DataFrame,
    current_only: bool = True,
    status_rule: Sequence[str] | None = None,
) -> DataFrame:
    """Entities in a ranked county, with the county's tiers and what they qualify for.

    ``current_only`` keeps the present version of each entity, so ``entity_id`` is
    unique. ``status_rule`` names the statuses that may qualify; none means all.
    """
    ranked = tiers.where(F.col("final_rank") > 0).select(
        "county",
        F.col("crime_rank").cast("int").alias("crime_tier"),
        F.col("income_rank").cast("int").alias("income_tier"),
        F.col("population_rank").cast("int").alias("population_tier"),
        F.round("final_rank").cast("int").alias("composite_tier"),
    )
    rows = business.where(F.col("is_current")) if current_only else business
    rows = rows.withColumn("_county", clean_key(F.col("principal_county")))
    counties = ranked.withColumnRenamed("county", "_county").withColumn(
        "_county", clean_key(F.col("_county"))
    )
    placed = lookup_left(rows.join(counties, "_county"), county_keys(geo), "_county", "county")
    qualifies = F.col("composite_tier") >= QUALIFYING_TIER
    if status_rule is not None:
        allowed = F.coalesce(F.col("entity_status").isin(list(status_rule)), F.lit(False))
        qualifies = qualifies & allowed
    return placed.select(
        "business_key",
        "entity_id",
        "entity_name",
        "principal_city",
        "principal_county",
        "principal_zip",
        "entity_type",
        "formation_date",
        "geo_key",
        "crime_tier",
        "income_tier",
        "population_tier",
        "composite_tier",
        qualifies.alias("qualifies_for_subsidy"),
        tier_label(F.col("composite_tier")).alias("subsidy_tier_label"),
        qualifies.alias("notification_eligible"),
    )
