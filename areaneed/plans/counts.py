"""The counts that tiers, dimensions and summary tables share.

One scan of the incidents and one of the fact feed all of them: each table reads its own set of
a small written table of counts, so a build reads the incidents once however many tables follow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaneed.functions.calendar import season
from areaneed.operators.groups import count_sets

INCIDENT_SETS = {
    "category": ["county_name", "offense_category_name"],
    "year": ["county_name", "incident_year"],
    "agency": ["agency_name", "county_name"],
    "offense": ["offense_category_name", "offense_name", "crime_against", "offense_group"],
}
FACT_SETS = {
    "county_month": ["geo_key", "year", "month", "offense_category_name"],
    "city_hour": ["city_geo_key", "season", "year", "incident_hour"],
    "city_category": ["city_geo_key", "season", "year", "offense_category_name"],
}


def incident_counts(incidents: DataFrame) -> DataFrame:
    """Incidents (``n``) and their first and last day, by each of ``INCIDENT_SETS``."""
    return count_sets(
        incidents,
        INCIDENT_SETS,
        F.min("incident_date").alias("first_date"),
        F.max("incident_date").alias("last_date"),
    )


def fact_counts(crimes: DataFrame, offense: DataFrame) -> DataFrame:
    """Incidents of the fact by each of ``FACT_SETS``.

    ``n`` counts all, ``placed`` those with a day of the calendar and an offense; ``ages`` and
    ``aged`` are the sum and number of known ages. An incident without an offense has a null category.
    """
    day = F.col("incident_date")
    rows = crimes.join(
        offense.select("offense_key", "offense_category_name"), "offense_key", "left"
    ).select(
        "geo_key",
        "city_geo_key",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        season(day).alias("season"),
        "incident_hour",
        "offense_category_name",
        "age_num",
        (F.col("date_key").isNotNull() & F.col("offense_category_name").isNotNull()).alias("whole"),
    )
    return count_sets(
        rows,
        FACT_SETS,
        F.count_if("whole").alias("placed"),
        F.sum("age_num").alias("ages"),
        F.count("age_num").alias("aged"),
    )


def of_set(counts: DataFrame, name: str) -> DataFrame:
    """The rows of one set, with its own columns and the aggregates."""
    sets = INCIDENT_SETS if name in INCIDENT_SETS else FACT_SETS
    others = {c for keys in sets.values() for c in keys} - set(sets[name])
    return counts.where(F.col("set") == name).drop("set", *others)
