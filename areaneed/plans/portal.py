"""Portal queries. ``tables`` maps table names to DataFrames; nothing is collected.

The fact is counted inside the map tasks before anything is shuffled, and facts of
different grain meet only after each is aggregated, so no count is multiplied by the
rows of another fact.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaneed.constants import SEARCH_ROWS
from areaneed.functions.scores import rate
from areaneed.functions.text import clean_key, initcap_delims
from areaneed.operators.groups import share_of
from areaneed.operators.joins import one_row
from areaneed.plans.facts import county_keys
from areaneed.plans.reports import with_category

Tables = Mapping[str, DataFrame]


def _limited(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.limit(limit)


def _title(col: str = "county"):
    return initcap_delims(F.col(col)).alias("county_name")


def _county_counts(tables: Tables, rows: DataFrame, *keys: str | Column) -> DataFrame:
    """Incidents per county and further columns."""
    counts = rows.groupBy("geo_key", *keys).agg(F.count("*").alias("n"))
    return counts.join(county_keys(tables["dim_geography"]), "geo_key").drop("geo_key")


def _county_economy(tables: Tables) -> DataFrame:
    """Mean population and median income of each county over all its years."""
    means = (
        tables["fct_income_population"]
        .groupBy("geo_key")
        .agg(
            F.avg("total_population").alias("avg_population"),
            F.avg("median_household_income").alias("avg_median_income"),
        )
    )
    return means.join(county_keys(tables["dim_geography"]), "geo_key").drop("geo_key")


def sq_county_crime_annual(tables: Tables, limit: int | None = None) -> DataFrame:
    """Incidents by county and year, most first."""
    counts = (
        tables["fct_crimes"]
        .groupBy("geo_key", F.year("incident_date").alias("year"))
        .agg(F.sum("crime_count").alias("total_crimes"))
    )
    rows = counts.join(county_keys(tables["dim_geography"]), "geo_key").select(
        F.col("county").alias("county_name"), "year", "total_crimes"
    )
    return _limited(rows.orderBy(F.desc("total_crimes"), "county_name", "year"), limit)


def sq_subsidy_by_county(tables: Tables, limit: int | None = None) -> DataFrame:
    """Entities and how many qualify, by county."""
    rows = (
        tables["fct_business_subsidy_tiers"]
        .groupBy("principal_county")
        .agg(
            F.count("*").alias("total_businesses"),
            F.count_if("qualifies_for_subsidy").alias("qualifying_businesses"),
        )
        .withColumn(
            "pct_qualifying",
            rate(F.col("qualifying_businesses"), F.col("total_businesses"), 100, 1),
        )
    )
    return _limited(rows.orderBy(F.desc("qualifying_businesses"), "principal_county"), limit)


def sq_income_population_annual(tables: Tables, limit: int | None = None) -> DataFrame:
    """Mean income and population by county and year, latest first."""
    rows = (
        tables["fct_income_population"]
        .groupBy("geo_key", "year")
        .agg(
            F.round(F.avg("median_household_income")).alias("avg_median_household_income"),
            F.round(F.avg("total_population")).alias("avg_total_population"),
        )
        .join(county_keys(tables["dim_geography"]), "geo_key")
        .select(
            F.col("county").alias("county_name"),
            "year",
            "avg_median_household_income",
            "avg_total_population",
        )
    )
    order = [F.desc("year"), F.col("avg_median_household_income").desc_nulls_last()]
    return _limited(rows.orderBy(*order, "county_name"), limit)


def crime_rate_spotlight(tables: Tables, limit: int | None = None) -> DataFrame:
    """Counties with the highest rate per 100,000, from the agency report."""
    totals = (
        tables["rpt_agency_baseline"]
        .groupBy(F.lower("county_name").alias("county"))
        .agg(F.sum("total_crimes").alias("total_crimes"))
    )
    rows = totals.join(_county_economy(tables), "county").select(
        _title(),
        "total_crimes",
        F.round("avg_population").alias("avg_population"),
        rate(F.col("total_crimes"), F.col("avg_population"), 100000, 1).alias(
            "crime_rate_per_100k"
        ),
    )
    order = F.col("crime_rate_per_100k").desc_nulls_last()
    return _limited(rows.orderBy(order, "county_name"), limit)


def headline_stats(tables: Tables) -> DataFrame:
    """One row: incidents, entities, qualifying entities, counties and year range."""
    crimes = tables["fct_crimes"].agg(
        F.count("*").alias("total_crimes"),
        F.year(F.min("incident_date")).alias("year_min"),
        F.year(F.max("incident_date")).alias("year_max"),
    )
    business = tables["rpt_business_tier_lookup"].agg(
        F.count("*").alias("total_businesses"),
        F.count_if("qualifies_for_subsidy").alias("qualifying_businesses"),
    )
    counties = county_keys(tables["dim_geography"]).agg(F.count("*").alias("counties"))
    return one_row([crimes, business, counties]).select(
        "total_crimes",
        "total_businesses",
        "qualifying_businesses",
        "year_min",
        "year_max",
        (F.col("year_max") - F.col("year_min") + 1).alias("years_of_data"),
        "counties",
    )


def _density(tables: Tables) -> DataFrame:
    return _county_counts(tables, tables["fct_crimes"]).join(_county_economy(tables), "county").select(
        _title(),
        F.col("n").alias("total_crimes"),
        "avg_population",
        "avg_median_income",
        rate(F.col("n"), F.col("avg_population"), 100000, 1).alias("crime_rate_per_100k"),
    )


def crime_density(tables: Tables, limit: int | None = None) -> DataFrame:
    """Incidents per 100,000 people by county."""
    rows = _density(tables).drop("avg_median_income")
    order = F.col("crime_rate_per_100k").desc_nulls_last()
    return _limited(rows.orderBy(order, "county_name"), limit)


def crime_vs_income(tables: Tables, limit: int | None = None) -> DataFrame:
    """The same beside mean median income, where that is known."""
    rows = _density(tables).where(F.col("avg_median_income").isNotNull())
    order = F.col("crime_rate_per_100k").desc_nulls_last()
    return _limited(rows.orderBy(order, "county_name"), limit)


def categories_by_county(tables: Tables, limit: int | None = None) -> DataFrame:
    """Incidents by county and offense category."""
    crimes = with_category(tables["fct_crimes"], tables["dim_offense"])
    rows = _county_counts(tables, crimes, "offense_category_name", "crime_against").select(
        _title(), "offense_category_name", "crime_against", F.col("n").alias("total_crimes")
    )
    order = ["county_name", F.desc("total_crimes"), "offense_category_name", "crime_against"]
    return _limited(rows.orderBy(*order), limit)


def type_share_by_county(tables: Tables, limit: int | None = None) -> DataFrame:
    """Share of Property / Person / Society in each county's incidents."""
    crimes = with_category(tables["fct_crimes"], tables["dim_offense"])
    counts = _county_counts(tables, crimes, "crime_against").withColumnRenamed(
        "n", "total_crimes"
    )
    rows = share_of(counts, "total_crimes", ["county"], "pct_of_county_crimes").select(
        _title(), "crime_against", "total_crimes", "pct_of_county_crimes"
    )
    return _limited(
        rows.orderBy("county_name", F.desc("total_crimes"), "crime_against"), limit
    )


def county_monthly(tables: Tables, limit: int | None = None) -> DataFrame:
    """Incidents by county and calendar month."""
    names = tables["dim_date"].select("month", "month_name", "season").distinct()
    crimes = tables["fct_crimes"].where(F.col("date_key").isNotNull())
    rows = (
        _county_counts(tables, crimes, F.month("incident_date").alias("month"))
        .join(names, "month")
        .select(_title(), "month", "month_name", "season", F.col("n").alias("total_crimes"))
    )
    return _limited(rows.orderBy("county_name", "month"), limit)


def income_population_by_county(tables: Tables, limit: int | None = None) -> DataFrame:
    """County-year income, population and growth."""
    rows = (
        tables["fct_income_population"]
        .join(county_keys(tables["dim_geography"]), "geo_key")
        .select(
            _title(),
            "year",
            "median_household_income",
            "per_capita_income",
            "total_population",
            "population_growth_pct",
            "population_yoy_change",
        )
    )
    return _limited(rows.orderBy("county_name", "year"), limit)


def tier_breakdown(tables: Tables, limit: int | None = None) -> DataFrame:
    """Entities by tier."""
    rows = (
        tables["rpt_business_tier_lookup"]
        .groupBy("composite_tier", "subsidy_tier_label")
        .agg(F.count("*").alias("businesses"))
    )
    return _limited(rows.orderBy(F.desc("composite_tier")), limit)


def eligible_by_county(tables: Tables, limit: int | None = None) -> DataFrame:
    """Entities to notify, by county."""
    rows = (
        tables["rpt_business_tier_lookup"]
        .where(F.col("notification_eligible") & F.col("principal_county").isNotNull())
        .groupBy("principal_county")
        .agg(F.count("*").alias("eligible_businesses"))
        .withColumn("principal_county", initcap_delims(F.col("principal_county")))
    )
    return _limited(rows.orderBy(F.desc("eligible_businesses"), "principal_county"), limit)


def eligible_total(tables: Tables) -> DataFrame:
    """Entities to notify, in all."""
    return tables["rpt_business_tier_lookup"].agg(
        F.count_if("notification_eligible").alias("eligible_businesses")
    )


def agency_baseline(tables: Tables, limit: int | None = None) -> DataFrame:
    """The agency report with county names capitalised."""
    rows = tables["rpt_agency_baseline"].withColumn(
        "county_name", initcap_delims(F.col("county_name"))
    )
    return _limited(rows, limit)


def city_report(
    tables: Tables, name: str, county: str | None = None, cities: list[str] | None = None
) -> DataFrame:
    """A written city report, rpt_city_time_trends, _time_of_day or _demographics, for the county and
    the cities picked (case and outer blanks do not count); what is not picked is not limited."""
    rows = tables[name]
    if county is not None:
        rows = rows.where(clean_key(F.col("county_name")) == clean_key(F.lit(county)))
    if cities is not None:
        picked = [clean_key(F.lit(city)) for city in cities]
        rows = rows.where(clean_key(F.col("city_name")).isin(picked))
    return rows


def search_businesses(
    lookup: DataFrame, term: str, max_rows: int = SEARCH_ROWS
) -> DataFrame | None:
    """Digits find that entity id; anything else, or no such id, a part of the name.

    The id is compared as a number, so the condition reaches the scan; digits that are no
    id as written (a leading zero, too long) can only be part of a name.
    """
    term = term.strip()
    if not term:
        return None
    if term.isdecimal() and str(int(term)) == term and int(term) < 1 << 63:
        by_id = lookup.where(F.col("entity_id") == F.lit(int(term)).cast("bigint"))
        if not by_id.isEmpty():
            return by_id.orderBy("entity_name", "entity_id").limit(max_rows)
    by_name = lookup.where(F.contains(F.upper("entity_name"), F.lit(term.upper())))
    return by_name.orderBy("entity_name", "entity_id").limit(max_rows)
