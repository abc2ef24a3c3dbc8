"""The five report tables.

The fact is read once and counted inside the map tasks; only counts are shuffled, so one
busy city or agency costs no more than any other. Offenses, a small dimension, are
looked up before the count, since a category stands for many offense keys and
leaves far fewer counts. Cities and agencies are looked up after it.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from areaneed.constants import COUNTY_LEVEL, REDUCTION_TARGET, TIER_MESSAGES, UNASSIGNED_MESSAGE
from areaneed.operators.groups import share_of, top_k_per_group


def _cities(geo: DataFrame) -> DataFrame:
    return geo.where(F.col("city_name") != COUNTY_LEVEL).select(
        F.col("geo_key").alias("city_geo_key"), "city_name", "county_name"
    )


def _in_cities(crimes: DataFrame) -> DataFrame:
    return crimes.where(F.col("city_geo_key").isNotNull())


def with_category(crimes: DataFrame, offense: DataFrame) -> DataFrame:
    """Incidents with their offense category and whom it is against."""
    return crimes.join(
        offense.select("offense_key", "offense_category_name", "crime_against"), "offense_key"
    )


def rpt_business_tier_lookup(
    tiers: DataFrame, program: str = "subsidy", contact: str = "the program office"
) -> DataFrame:
    """What an entity sees when it looks itself up."""
    message = F.lit(UNASSIGNED_MESSAGE.format(contact=contact))
    for tier, text in TIER_MESSAGES.items():
        message = F.when(
            F.col("composite_tier") == tier, text.format(program=program)
        ).otherwise(message)
    return tiers.select(
        "entity_id",
        "entity_name",
        "principal_city",
        "principal_county",
        "principal_zip",
        "entity_type",
        "formation_date",
        "crime_tier",
        "income_tier",
        "population_tier",
        "composite_tier",
        "subsidy_tier_label",
        "qualifies_for_subsidy",
        "notification_eligible",
        message.alias("subsidy_message"),
    )


def rpt_agency_baseline(crimes: DataFrame, agency: DataFrame) -> DataFrame:
    """Incidents per agency, its 5% reduction target, first and last incident."""
    per_agency = (
        crimes.where(F.col("agency_key").isNotNull())
        .groupBy("agency_key")
        .agg(
            F.count("*").alias("total_crimes"),
            F.min("incident_date").alias("first_incident_date"),
            F.max("incident_date").alias("last_incident_date"),
        )
    )
    target = F.round(F.col("total_crimes") * F.lit(Decimal(REDUCTION_TARGET)))
    return per_agency.join(agency, "agency_key").select(
        F.col("primary_county").alias("county_name"),
        "agency_name",
        "total_crimes",
        target.cast("bigint").alias("target_crimes_5pct_reduction"),
        "first_incident_date",
        "last_incident_date",
    )


def rpt_city_demographics(crimes: DataFrame, geo: DataFrame, offense: DataFrame) -> DataFrame:
    """Per city and offense category: incidents, mean age, share of the city's incidents."""
    counts = (
        with_category(_in_cities(crimes), offense)
        .groupBy("city_geo_key", "offense_category_name", "crime_against")
        .agg(
            F.count("*").alias("n"),
            F.sum("age_num").alias("age_sum"),
            F.count("age_num").alias("age_rows"),
        )
    )
    rows = (
        counts.join(_cities(geo), "city_geo_key")
        .groupBy("city_name", "county_name", "offense_category_name", "crime_against")
        .agg(
            F.sum("n").alias("total_crimes"),
            F.round(F.try_divide(F.sum("age_sum"), F.sum("age_rows")), 1).alias(
                "avg_offender_age"
            ),
        )
    )
    return share_of(rows, "total_crimes", ["city_name"], "pct_of_city_crimes").orderBy(
        "city_name",
        F.desc("total_crimes"),
        "county_name",
        "offense_category_name",
        "crime_against",
    )


def rpt_city_time_of_day(
    crimes: DataFrame, geo: DataFrame, offense: DataFrame, k: int = 3
) -> DataFrame:
    """The ``k`` commonest offense categories of each city, by day and by night."""
    counts = (
        with_category(_in_cities(crimes), offense)
        .groupBy("city_geo_key", "time_of_day", "offense_category_name", "crime_against")
        .agg(F.count("*").alias("n"))
    )
    rows = (
        counts.join(_cities(geo), "city_geo_key")
        .groupBy(
            "city_name", "county_name", "time_of_day", "offense_category_name", "crime_against"
        )
        .agg(F.sum("n").alias("crime_count"))
    )
    order = [
        F.desc("crime_count"),
        F.asc("county_name"),
        F.asc("offense_category_name"),
        F.asc("crime_against"),
    ]
    return top_k_per_group(rows, ["city_name", "time_of_day"], order, k).orderBy(
        "city_name", "time_of_day", "rnk"
    )


def rpt_city_time_trends(crimes: DataFrame, geo: DataFrame, date: DataFrame) -> DataFrame:
    """Per city, month and week day: incidents beside the city's monthly and daily means.

    The means are over the rows of the report (at most 84 per city and county). Month and
    week day come from the incident's own date; the calendar adds their names.
    """
    names = date.select(
        "month", "month_name", "season", "day_of_week", "day_name"
    ).distinct()
    counts = (
        _in_cities(crimes)
        .where(F.col("date_key").isNotNull())
        .groupBy(
            "city_geo_key",
            F.month("incident_date").alias("month"),
            F.dayofweek("incident_date").alias("day_of_week"),
        )
        .agg(F.count("*").alias("n"))
    )
    rows = (
        counts.join(names, ["month", "day_of_week"])
        .join(_cities(geo), "city_geo_key")
        .groupBy(
            "city_name", "county_name", "month", "month_name", "season", "day_of_week", "day_name"
        )
        .agg(F.sum("n").alias("total_crimes"))
    )

    def city_mean(label: str):
        return F.round(F.avg("total_crimes").over(Window.partitionBy("city_name", label)), 1)

    return rows.withColumns(
        {
            "avg_monthly_crimes": city_mean("month_name"),
            "avg_dow_crimes": city_mean("day_of_week"),
        }
    ).orderBy("city_name", "month", "day_of_week", "county_name")
