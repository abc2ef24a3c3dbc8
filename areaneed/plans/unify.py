"""The two unified tables every model reads: incidents and county-year economy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaneed.constants import (
    CRIME_AGAINST,
    FIRST_YEAR,
    INCOME_TYPES,
    LAST_YEAR,
    ROLLUP_AREAS,
    UNSPECIFIED_COUNTY,
)
from areaneed.functions.calendar import season, time_of_day
from areaneed.functions.text import (
    clean_key,
    initcap_delims,
    normalize_agency,
    normalize_county,
    normalize_county_list,
)
from areaneed.operators.groups import pivot_max, yoy


def _reportable(staged: DataFrame) -> DataFrame:
    return staged.where(
        F.col("crime_against").isin(CRIME_AGAINST)
        & F.col("incident_date").isNotNull()
        & (clean_key(F.col("county_name")) != UNSPECIFIED_COUNTY)
        & F.col("agency_name").isNotNull()
    )


def int_crimes_unified(early: DataFrame, late: DataFrame, agency_city: DataFrame) -> DataFrame:
    """Both periods in one cleaned table with date parts, day/night and season.

    The late period takes its city from the agency list, matched on the raw agency
    name; a name listed twice takes its first city, so no incident is doubled. Everything
    else is one pass over the rows. A listed agency is cleaned once in the list; the costly
    patterns run per incident for the other agencies only.
    """
    listed = agency_city.groupBy(F.col("pub_agency_name").alias("agency_name"))
    city = listed.agg(F.min("city_name").alias("city_name")).withColumn(
        "listed_name", normalize_agency(F.col("agency_name"))
    )
    with_city = _reportable(late).join(city, "agency_name", "left")
    rows = (
        _reportable(early)
        .drop("agency_type_name")
        .unionByName(with_city, allowMissingColumns=True)
    )
    day = F.col("incident_date")
    return rows.select(
        F.coalesce("listed_name", normalize_agency(F.col("agency_name"))).alias("agency_name"),
        normalize_county_list(F.col("county_name")).alias("county_name"),
        "city_name",
        "incident_date",
        "incident_hour",
        initcap_delims(clean_key(F.col("offense_name"))).alias("offense_name"),
        "crime_against",
        "offense_category_name",
        "offense_group",
        "age_num",
        "source_period",
        F.year(day).alias("incident_year"),
        F.month(day).alias("incident_month"),
        F.dayofmonth(day).alias("incident_day"),
        F.dayofweek(day).alias("day_of_week"),
        time_of_day(F.col("incident_hour")).alias("time_of_day"),
        season(day).alias("season"),
    )


def int_income_population(
    income: DataFrame,
    population: DataFrame,
    year_from: int = FIRST_YEAR,
    year_to: int = LAST_YEAR,
) -> DataFrame:
    """One row per county and year: income by type beside population and its growth."""
    in_range = F.col("year").between(year_from, year_to)
    normalized = normalize_county(F.col("county")).alias("county_normalized")

    incomes = pivot_max(
        income.where(
            in_range & F.col("income").isNotNull() & ~F.col("county").isin(ROLLUP_AREAS)
        ).select("*", normalized),
        ["county", "county_normalized", "year"],
        "income_type_code",
        INCOME_TYPES,
        "income",
        F.max("population").alias("reported_population"),
    )
    people = (
        population.where(in_range)
        .select("*", normalized)
        .groupBy("county", "county_normalized", "year")
        .agg(
            F.sum("total_population").alias("counted_population"),
            F.sum("male_population").alias("male_population"),
            F.sum("female_population").alias("female_population"),
        )
    )
    people = yoy(
        people,
        ["county_normalized"],
        ["year", "county"],
        "counted_population",
        prior="prior_year_population",
        change="population_yoy_change",
        growth="population_growth_pct",
    ).drop("county")

    return incomes.join(people, ["county_normalized", "year"], "left").select(
        "county",
        "county_normalized",
        "year",
        *INCOME_TYPES.values(),
        "male_population",
        "female_population",
        "prior_year_population",
        "population_yoy_change",
        "population_growth_pct",
        F.coalesce("counted_population", "reported_population").alias("total_population"),
    )
