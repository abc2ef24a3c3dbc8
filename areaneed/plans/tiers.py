"""Need tiers 1-4 of each county, by incidents, income and incidents per person.

Incidents are counted per county first; all that follows works on one row per county. Where
incidents are asked for, counts of them (a column ``n``) do as well.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaneed.constants import CRIME_CATEGORIES
from areaneed.functions.scores import mean_of_present
from areaneed.functions.text import clean_key
from areaneed.operators.groups import how_many, pivot_max, quartile_tier
from areaneed.operators.joins import drill_across


def crime_tiers(incidents: DataFrame, categories: Iterable[str] = CRIME_CATEGORIES) -> DataFrame:
    """Per category, the tier of each county by its number of incidents."""
    counts = (
        incidents.where(F.col("offense_category_name").isin(list(categories)))
        .groupBy("county_name", "offense_category_name")
        .agg(how_many(incidents).alias("total_crimes"))
    )
    return quartile_tier(
        counts,
        "total_crimes",
        ["offense_category_name"],
        percentile="crime_percentile",
        tier="crime_tier",
    ).withColumn("county_name", clean_key(F.col("county_name")))


def crime_tier_county_rank(
    tiers: DataFrame, categories: dict[str, str] = CRIME_CATEGORIES
) -> DataFrame:
    """One row per county: the tier in each category and their rounded mean."""
    return pivot_max(
        tiers,
        ["county_name"],
        "offense_category_name",
        categories,
        "crime_tier",
        F.round(F.avg("crime_tier")).cast("int").alias("overall_crime_tier"),
    )


def income_tier(income_population: DataFrame) -> DataFrame:
    """Inverse tier by mean median household income: the poorest quarter is tier 4."""
    means = (
        income_population.where(F.col("median_household_income").isNotNull())
        .groupBy(F.col("county_normalized").alias("county"))
        .agg(F.avg("median_household_income").alias("avg_median_household_income"))
    )
    return quartile_tier(
        means,
        "avg_median_household_income",
        inverse=True,
        percentile="income_percentile",
        tier="income_tier",
    )


def per_capita_tier(incidents: DataFrame, income_population: DataFrame) -> DataFrame:
    """Tier by mean yearly incidents per 1,000 people.

    Incidents are counted per county and year before the join, so the join sees
    county-years, not incidents.
    """
    yearly = incidents.groupBy(
        clean_key(F.col("county_name")).alias("county"), F.col("incident_year").alias("year")
    ).agg(how_many(incidents).alias("n"))
    people = income_population.where(F.col("total_population") > 0).select(
        F.col("county_normalized").alias("county"), "year", "total_population"
    )
    means = (
        yearly.join(people, ["county", "year"])
        .groupBy("county")
        .agg(F.avg(F.col("n") / F.col("total_population") * 1000).alias("avg_crime_per_1000"))
    )
    return quartile_tier(
        means,
        "avg_crime_per_1000",
        percentile="crime_percentile",
        tier="crime_per_capita_tier",
    )


def final_county_tier_rank(
    crime: DataFrame, income: DataFrame, per_capita: DataFrame
) -> DataFrame:
    """The three ranks side by side (0 when missing) and the mean of those present."""
    legs = [
        (crime, "county_name", "overall_crime_tier", "crime_rank"),
        (income, "county", "income_tier", "income_rank"),
        (per_capita, "county", "crime_per_capita_tier", "population_rank"),
    ]
    frames = [
        df.where(F.col(tier) > 0).select(
            clean_key(F.col(area)).alias("county"), F.col(tier).alias(rank)
        )
        for df, area, tier, rank in legs
    ]
    names = [rank for *_, rank in legs]
    ranks = drill_across(frames, ["county"]).fillna(0, names)
    return ranks.withColumn("final_rank", mean_of_present(*[F.col(n) for n in names]))
