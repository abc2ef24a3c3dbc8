"""Thirteen fixed questions over the report tables, each a group, a sort and a limit.

Every order ends in the group's own columns, so equal counts always come out alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaneed.plans.portal import Tables


def _top(
    df: DataFrame, keys: list[str], measure: Column, name: str, limit: int | None
) -> DataFrame:
    rows = df.groupBy(*keys).agg(measure.alias(name)).orderBy(F.desc(name), *keys)
    return rows if limit is None else rows.limit(limit)


def _crimes() -> Column:
    return F.sum("total_crimes")


def vq_top_crime_cities(t: Tables, limit: int | None = 10) -> DataFrame:
    return _top(t["rpt_city_time_trends"], ["city_name"], _crimes(), "total_crimes", limit)


def vq_crime_by_season(t: Tables, limit: int | None = None) -> DataFrame:
    return _top(t["rpt_city_time_trends"], ["season"], _crimes(), "total_crimes", limit)


def vq_crime_by_day_of_week(t: Tables, limit: int | None = None) -> DataFrame:
    return _top(t["rpt_city_time_trends"], ["day_name"], _crimes(), "total_crimes", limit)


def vq_most_common_crime_types(t: Tables, limit: int | None = 15) -> DataFrame:
    keys = ["offense_category_name", "crime_against"]
    return _top(t["rpt_city_demographics"], keys, _crimes(), "total_crimes", limit)


def vq_county_crime_totals(t: Tables, limit: int | None = 10) -> DataFrame:
    return _top(t["rpt_agency_baseline"], ["county_name"], _crimes(), "total_crimes", limit)


def vq_statewide_prevention_target(t: Tables, limit: int | None = None) -> DataFrame:
    sums = t["rpt_agency_baseline"].agg(
        _crimes().alias("baseline_crimes"),
        F.sum("target_crimes_5pct_reduction").alias("target_crimes"),
    )
    return sums.withColumn("crimes_to_prevent", F.col("baseline_crimes") - F.col("target_crimes"))


def vq_qualifying_businesses_by_county(t: Tables, limit: int | None = 20) -> DataFrame:
    rows = t["rpt_business_tier_lookup"].where("qualifies_for_subsidy")
    return _top(rows, ["principal_county"], F.count("*"), "qualifying_businesses", limit)


def vq_tier_4_businesses(t: Tables, limit: int | None = None) -> DataFrame:
    return t["rpt_business_tier_lookup"].agg(
        F.count_if(F.col("composite_tier") == 4).alias("tier_4_businesses")
    )


def vq_weekend_vs_weekday(t: Tables, limit: int | None = None) -> DataFrame:
    weekend = F.col("day_name").isin("Saturday", "Sunday")
    rows = t["rpt_city_time_trends"].withColumn(
        "day_type", F.when(weekend, "Weekend").otherwise("Weekday")
    )
    return _top(rows, ["day_type"], _crimes(), "total_crimes", limit)


def vq_top_agencies_by_crime(t: Tables, limit: int | None = 15) -> DataFrame:
    columns = ["agency_name", "county_name", "total_crimes", "target_crimes_5pct_reduction"]
    rows = t["rpt_agency_baseline"].select(*columns).orderBy(F.desc("total_crimes"), "agency_name")
    return rows if limit is None else rows.limit(limit)


def vq_property_crime_cities(t: Tables, limit: int | None = 10) -> DataFrame:
    rows = t["rpt_city_demographics"].where(F.col("crime_against") == "Property")
    return _top(rows, ["city_name"], _crimes(), "property_crimes", limit)


def vq_avg_age_by_crime_type(t: Tables, limit: int | None = 15) -> DataFrame:
    rows = t["rpt_city_demographics"].where(F.col("avg_offender_age").isNotNull())
    keys = ["offense_category_name", "crime_against"]
    # The ages have one decimal; averaging them as decimals is exact in any order.
    mean = F.avg(F.col("avg_offender_age").cast("decimal(10,1)"))
    return _top(rows, keys, F.round(mean, 1).cast("double"), "avg_age", limit)


def vq_notification_eligible_by_county(t: Tables, limit: int | None = 20) -> DataFrame:
    rows = t["rpt_business_tier_lookup"].where("notification_eligible")
    name = "notification_eligible_businesses"
    return _top(rows, ["principal_county"], F.count("*"), name, limit)


VERIFIED = {
    f.__name__: f
    for f in (
        vq_top_crime_cities,
        vq_crime_by_season,
        vq_crime_by_day_of_week,
        vq_most_common_crime_types,
        vq_county_crime_totals,
        vq_statewide_prevention_target,
        vq_qualifying_businesses_by_county,
        vq_tier_4_businesses,
        vq_weekend_vs_weekday,
        vq_top_agencies_by_crime,
        vq_property_crime_cities,
        vq_avg_age_by_crime_type,
        vq_notification_eligible_by_county,
    )
}
