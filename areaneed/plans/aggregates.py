"""Three declared summary tables whose columns are given but whose rules are ours.

All are made of ``fact_counts``: the incidents themselves are not read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areaneed.functions.scores import mean_of_present, rate
from areaneed.operators.groups import quartile_tier
from areaneed.operators.joins import drill_across
from areaneed.plans.counts import of_set
from areaneed.plans.facts import county_keys


def _commonest(value: str) -> Column:
    """Known value with the most rows ('n'); ties go to the smaller value."""
    place = F.struct((-F.col("n")).alias("n"), F.col(value))
    return F.min(F.when(F.col(value).isNotNull(), place))[value]


def agg_county_month(
    counts: DataFrame, geo: DataFrame, income_population: DataFrame
) -> DataFrame:
    """Per county and month: incidents, rate per 100,000 people, mean age, top category.

    Incidents without an offense take no part."""
    months = (
        of_set(counts, "county_month")
        .where(F.col("offense_category_name").isNotNull())
        .groupBy("geo_key", "year", "month")
        .agg(
            F.sum("n").alias("total_crimes"),
            F.round(F.try_divide(F.sum("ages"), F.sum("aged")), 2).alias("avg_age"),
            _commonest("offense_category_name").alias("top_offense_category"),
        )
    )
    people = income_population.groupBy("geo_key", "year").agg(
        F.max("total_population").alias("people")
    )
    return (
        months.join(county_keys(geo), "geo_key")
        .join(people, ["geo_key", "year"], "left")
        .select(
            F.col("county").alias("county_name"),
            "year",
            "month",
            "total_crimes",
            rate(F.col("total_crimes"), F.col("people"), 100000, 2).alias("crimes_per_100k"),
            "avg_age",
            "top_offense_category",
        )
    )


def agg_tier_rankings(
    counts: DataFrame, geo: DataFrame, income_population: DataFrame
) -> DataFrame:
    """Per county and year: three scores among that year's counties, tier and rank.

    Rank 1 has the highest sum of scores. A year has one row per county, so the windows
    hold a few dozen rows.
    """
    yearly = of_set(counts, "county_month").groupBy("geo_key", "year").agg(F.sum("n").alias("n"))
    economy = income_population.groupBy("geo_key", "year").agg(
        F.max("total_population").alias("people"),
        F.max("median_household_income").alias("income"),
    )
    incidents = quartile_tier(yearly, "n", ["year"], tier="crime_score")
    incomes = quartile_tier(
        economy.where(F.col("income").isNotNull()), "income", ["year"], True, tier="income_score"
    )
    rates = quartile_tier(
        yearly.join(economy.where(F.col("people") > 0), ["geo_key", "year"]).withColumn(
            "rate", F.col("n") * 1000 / F.col("people")
        ),
        "rate",
        ["year"],
        tier="population_score",
    )
    names = ["crime_score", "income_score", "population_score"]
    scores = drill_across(
        [
            df.where(F.col("geo_key").isNotNull()).select("geo_key", "year", name)
            for df, name in zip([incidents, incomes, rates], names)
        ],
        ["geo_key", "year"],
    ).fillna(0, names)
    total = F.col("crime_score") + F.col("income_score") + F.col("population_score")
    place = Window.partitionBy("year").orderBy(total.desc())
    return (
        scores.withColumn("tier_rank", F.rank().over(place))
        .join(county_keys(geo), "geo_key")
        .select(
            F.col("county").alias("county_name"),
            "year",
            *names,
            F.concat(F.lit("Tier "), mean_of_present(*[F.col(n) for n in names])).alias(
                "overall_tier"
            ),
            "tier_rank",
        )
    )


def agg_city_season(counts: DataFrame, geo: DataFrame, date: DataFrame) -> DataFrame:
    """Per city, season and calendar year: incidents per day, peak hour, top category.

    Incidents without a day of the calendar or an offense take no part."""
    cities = geo.select(F.col("geo_key").alias("city_geo_key"), "city_name")
    season_days = date.groupBy("season", "year").agg(F.count("*").alias("days"))
    keys = ["city_name", "season", "year"]
    cells = (
        counts.where(F.col("set").isin("city_hour", "city_category") & (F.col("placed") > 0))
        .join(cities, "city_geo_key")
        .groupBy(*keys, "set", "incident_hour", "offense_category_name")
        .agg(F.sum("placed").alias("n"))
    )
    by_hour = F.col("set") == "city_hour"
    return (
        cells.groupBy(*keys)
        .agg(
            F.sum(F.when(by_hour, F.col("n"))).alias("total"),
            _commonest("incident_hour").alias("peak_crime_hour"),
            _commonest("offense_category_name").alias("top_offense_type"),
        )
        .join(season_days, ["season", "year"])
        .select(
            *keys,
            F.round(F.col("total") / F.col("days"), 4).alias("avg_crimes_per_day"),
            "peak_crime_hour",
            "top_offense_type",
        )
    )
