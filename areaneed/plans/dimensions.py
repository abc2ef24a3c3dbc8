"""The five dimensions of the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areaneed.constants import (
    CALENDAR_END_EXCLUSIVE,
    CALENDAR_START,
    COUNTY_LEVEL,
    CRIME_AGAINST,
    GOOD_STANDING,
    HOME_STATE,
    UNKNOWN,
)
from areaneed.functions.calendar import day_name, is_weekend, month_name, season
from areaneed.functions.text import clean_key, clean_zip
from areaneed.operators.groups import first_of_group, how_many, with_key
from areaneed.operators.joins import lookup_left


def dim_date(
    spark: SparkSession,
    start: dt.date | str = CALENDAR_START,
    end_exclusive: dt.date | str = CALENDAR_END_EXCLUSIVE,
) -> DataFrame:
    """One row per day from ``start`` up to, not including, ``end_exclusive``."""
    bounds = spark.range(1).select(
        F.lit(str(start)).cast("date").alias("start"),
        F.lit(str(end_exclusive)).cast("date").alias("end_exclusive"),
    )
    return calendar(bounds)


def dim_date_spanning(
    incidents: DataFrame, first: str = "incident_date", last: str = "incident_date"
) -> DataFrame:
    """Whole calendar years from the first to the last incident."""
    span = incidents.agg(F.min(first).alias("first"), F.max(last).alias("last"))
    return calendar(
        span.select(
            F.trunc("first", "year").alias("start"),
            F.add_months(F.trunc("last", "year"), 12).alias("end_exclusive"),
        )
    )


def calendar(bounds: DataFrame) -> DataFrame:
    """Calendar rows for a one-row frame with ``start`` and ``end_exclusive``."""
    days = bounds.select(
        F.explode(F.sequence("start", F.date_sub("end_exclusive", 1))).alias("date_day")
    )
    day = F.col("date_day")
    text = F.date_format(day, "MM/dd/yyyy")
    return days.select(
        "date_day",
        text.alias("full_date"),
        text.alias("date_key"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        month_name(day).alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        day_name(day).alias("day_name"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        season(day).alias("season"),
        is_weekend(day).alias("is_weekend"),
    )


def dim_geography(
    zip_lookup: DataFrame,
    centroids: DataFrame,
    state: str = HOME_STATE,
    known: DataFrame | None = None,
) -> DataFrame:
    """City-zip rows and one county-level row per county, with centroids and a key.

    ``known``, here and below, is the dimension as last built: its rows keep their keys."""
    cities = lookup_left(
        zip_lookup.select(F.col("city").alias("city_name"), "zip_code", "county"),
        centroids.select("county_label", "cent_lat", "cent_long"),
        "county",
        "county_label",
    ).withColumnRenamed("county", "county_name")
    counties = centroids.select(
        F.lit(COUNTY_LEVEL).alias("city_name"),
        F.lit(None).cast("string").alias("zip_code"),
        clean_key(F.col("county_label")).alias("county_name"),
        "cent_lat",
        "cent_long",
    )
    rows = cities.unionByName(counties).distinct()
    order = ["county_name", "city_name", "zip_code"]
    return with_key(rows, order, "geo_key", known).select(
        "city_name",
        "county_name",
        "zip_code",
        "cent_lat",
        "cent_long",
        F.lit(state).alias("state"),
        "geo_key",
    )


def dim_offense(incidents: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Distinct offenses; a missing group is 'Unknown', which also breaks key ties."""
    rows = (
        incidents.where(
            F.col("offense_category_name").isNotNull()
            & F.col("crime_against").isin(CRIME_AGAINST)
        )
        .select(
            "offense_category_name",
            "offense_name",
            "crime_against",
            F.coalesce("offense_group", F.lit(UNKNOWN)).alias("offense_group"),
        )
        .distinct()
    )
    order = ["crime_against", "offense_category_name", "offense_name", "offense_group"]
    return with_key(rows, order, "offense_key", known).select(
        "offense_category_name", "offense_name", "crime_against", "offense_key", "offense_group"
    )


def dim_agency(incidents: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Each agency with the county it reports most, from incidents or counts of them (``n``); ties go
    to the first name."""
    counts = (
        incidents.where(F.col("agency_name").isNotNull())
        .groupBy("agency_name", "county_name")
        .agg(how_many(incidents).alias("n"))
    )
    main = first_of_group(
        counts, ["agency_name"], [F.col("n").desc(), F.col("county_name").asc_nulls_last()]
    )
    rows = main.select("agency_name", F.col("county_name").alias("primary_county"))
    return with_key(rows, ["agency_name"], "agency_key", known).select(
        "agency_name", "primary_county", "agency_key"
    )


def surrogate_key(*cols: Column) -> Column:
    """md5 over the parts, in which a null is spelled out and so never drops out."""
    return F.md5(F.concat_ws("-", *[F.coalesce(c, F.lit("(null)")) for c in cols]))


def dim_business(
    history: DataFrame, zip_lookup: DataFrame, run_ts: dt.datetime | str
) -> DataFrame:
    """Every entity version with its county from zip, else city, else the state field.

    The lookup is reduced to one row per zip and one per city, so versions never fan out.
    """
    by_zip = first_of_group(zip_lookup, ["zip_code"], [F.col("city"), F.col("county")]).select(
        F.col("zip_code").alias("clean_zip_code"),
        F.col("city").alias("zip_city"),
        F.col("county").alias("zip_county"),
    )
    by_city = zip_lookup.groupBy("city").agg(F.min("county").alias("city_county"))
    versions = history.withColumn("clean_zip_code", clean_zip(F.col("principal_zip_code")))
    located = lookup_left(
        versions.join(by_zip, "clean_zip_code", "left"), by_city, "principal_city", "city"
    )
    return located.select(
        surrogate_key(
            F.col("entity_id").cast("string"),
            F.date_format("valid_from", "yyyy-MM-dd HH:mm:ss"),
        ).alias("business_key"),
        F.col("scd_id").alias("business_scd_id"),
        "entity_id",
        F.coalesce("entity_name", F.lit(UNKNOWN)).alias("entity_name"),
        "principal_address_1",
        F.coalesce("zip_city", clean_key(F.col("principal_city"))).alias("principal_city"),
        F.coalesce("zip_county", "city_county", clean_key(F.col("principal_state"))).alias(
            "principal_county"
        ),
        "principal_state",
        F.col("clean_zip_code").alias("principal_zip"),
        "entity_status",
        "entity_type",
        F.col("entity_form_date").alias("formation_date"),
        F.col("jurisdiction_of_formation").alias("jurisdiction"),
        (F.col("entity_status") == GOOD_STANDING).alias("is_eligible"),
        F.col("valid_to").isNull().alias("is_current"),
        "valid_from",
        "valid_to",
        F.lit(str(run_ts)).cast("timestamp_ntz").alias("dw_updated_at"),
    )
