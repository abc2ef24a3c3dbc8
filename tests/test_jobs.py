"""Jobs on hand-made inputs: the given/expect pairs, and the known hazards."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from areaneed.constants import COUNTY_LEVEL
from areaneed.plans import dimensions, facts, metrics, portal, reports, tiers, unify

HISTORY = """scd_id string, entity_id bigint, entity_name string, entity_status string,
entity_type string, entity_form_date date, jurisdiction_of_formation string,
principal_address_1 string, principal_city string, principal_state string,
principal_zip_code string, valid_from timestamp_ntz, valid_to timestamp_ntz"""
FORMED = dt.date(2020, 1, 15)
T1, T2 = dt.datetime(2023, 1, 1), dt.datetime(2024, 6, 1)
INCIDENT = """incident_date date, county_name string, city_name string, agency_name string,
offense_category_name string, offense_name string, crime_against string, offense_group string,
incident_hour int, time_of_day string, age_num int, source_period string"""


def version(key, name, city, state, zip_code, start, end, scd="h"):
    return (scd, key, name, "Good Standing", "LLC", FORMED, "Colorado", "123 Main St", city,
            state, zip_code, start, end)


def zips(spark, *rows):
    return spark.createDataFrame(list(rows), "zip_code string, city string, county string")


def test_current_flag_and_county_from_zip(spark):
    history = spark.createDataFrame(
        [
            version(71, "Mesa Tools", "Denver", "Denver", "80202", T1, T2, "old"),
            version(71, "Mesa Tools Ltd", "Denver", "Denver", "80202", T2, None, "new"),
        ],
        HISTORY,
    )
    dim = dimensions.dim_business(history, zips(spark, ("80202", "denver", "denver")), T2)
    seen = {
        (r.entity_id, r.is_current, r.principal_county, r.entity_name, r.is_eligible)
        for r in dim.collect()
    }
    assert seen == {
        (71, True, "denver", "Mesa Tools Ltd", True),
        (71, False, "denver", "Mesa Tools", True),
    }
    assert dim.select("business_key").distinct().count() == 2


def test_null_entity_name_is_unknown(spark):
    history = spark.createDataFrame(
        [version(72, None, "Boulder", "Boulder", "80301", T1, None)], HISTORY
    )
    row = dimensions.dim_business(history, zips(spark, ("80301", "boulder", "boulder")), T2).first()
    assert (row.entity_id, row.entity_name, row.is_current) == (72, "Unknown", True)


def test_county_falls_back_to_city_then_state_and_never_fans_out(spark):
    history = spark.createDataFrame(
        [
            version(1, "a", "DENVERL", "CO", "80202-1234", T1, None),
            version(2, "b", " Aurora ", "CO", "bad", T1, None),
            version(3, "c", "Nowhere", "CO", "99999", T1, None),
            version(4, "d", None, None, None, T1, None),
        ],
        HISTORY,
    )
    lookup = zips(
        spark,
        ("80202", "denver", "denver"),
        ("80202", "denver north", "denver"),
        ("80010", "aurora", "arapahoe"),
        ("80011", "aurora", "adams"),
    )
    rows = dimensions.dim_business(history, lookup, T2).orderBy("entity_id").collect()
    assert [(r.principal_county, r.principal_city) for r in rows] == [
        ("denver", "denver"),
        ("adams", "aurora"),
        ("co", "nowhere"),
        (None, None),
    ]


def test_tier_three_and_up_qualifies(spark):
    business = spark.createDataFrame(
        [
            (f"key_{i}", i * 100, n, n, n, z, "LLC", FORMED, True, s)
            for i, n, z, s in [
                (1, "Denver", "80202", "Good Standing"),
                (2, "Boulder", "80301", "Good Standing"),
                (3, "Nowhere", "99999", "Good Standing"),
                (4, "Denver", "80202", "Delinquent"),
            ]
        ],
        """business_key string, entity_id bigint, entity_name string, principal_city string,
        principal_county string, principal_zip string, entity_type string, formation_date date,
        is_current boolean, entity_status string""",
    )
    ranks = spark.createDataFrame(
        [("denver", 4, 4, 4, 4), ("boulder", 2, 2, 2, 2)],
        "county string, crime_rank int, income_rank int, population_rank int, final_rank int",
    )
    geo = spark.createDataFrame(
        [(1, "denver", COUNTY_LEVEL), (2, "boulder", COUNTY_LEVEL)],
        "geo_key bigint, county_name string, city_name string",
    )
    fact = facts.fct_business_subsidy_tiers(business, ranks, geo)
    seen = {
        (r.business_key, r.composite_tier, r.qualifies_for_subsidy, r.subsidy_tier_label,
         r.notification_eligible, r.geo_key)
        for r in fact.collect()
    }
    top = (4, True, "Tier 4 - Maximum Subsidy", True, 1)
    assert seen == {
        ("key_1", *top),
        ("key_2", 2, False, "Tier 2 - Standard Subsidy", False, 2),
        ("key_4", *top),
    }
    ruled = facts.fct_business_subsidy_tiers(business, ranks, geo, status_rule=["Good Standing"])
    assert {r.business_key for r in ruled.where("qualifies_for_subsidy").collect()} == {"key_1"}
    message = reports.rpt_business_tier_lookup(fact, "test", "us").first().subsidy_message
    assert "under the test program" in message


def star(spark, incidents):
    lookup = zips(
        spark,
        ("80202", "denver", "denver"),
        ("80203", "denver", "denver"),
        ("80204", "denver", "denver"),
        ("80301", "boulder", "boulder"),
    )
    centroids = spark.createDataFrame(
        [("DENVER", "Denver", 1.0, 2.0), ("BOULDER", "Boulder", 3.0, 4.0)],
        "county_code string, county_label string, cent_lat double, cent_long double",
    )
    dims = {
        "date": dimensions.dim_date(spark),
        "agency": dimensions.dim_agency(incidents),
        "offense": dimensions.dim_offense(incidents),
        "geography": dimensions.dim_geography(lookup, centroids),
    }
    fact = facts.fct_crimes(
        incidents, dims["date"], dims["agency"], dims["offense"], dims["geography"]
    )
    return fact, dims


def incident(county="denver", city="Denver", agency="Denver", group=None, day=None, age=25):
    return (day or dt.date(2020, 1, 1), county, city, agency, "Assault", "Aggravated Assault",
            "Person", group, 14, "day", age, "2016_2020")


def test_fact_grain(spark):
    incidents = spark.createDataFrame([incident(group="Violent Crime")], INCIDENT)
    fact, _ = star(spark, incidents)
    row = fact.first()
    assert fact.count() == 1
    assert (row.date_key, row.crime_count, row.agency_key, row.offense_key) == (
        "01/01/2020", 1, 1, 1,
    )
    assert row.geo_key is not None and row.city_geo_key is not None


def test_many_zips_and_groups_do_not_multiply_incidents(spark):
    """As written elsewhere, a city's zips and an offense's groups would each add rows."""
    incidents = spark.createDataFrame(
        [incident(), incident(group="A"), incident(group="B"), incident(city=COUNTY_LEVEL),
         incident(city=None), incident(county="denver, weld"), incident(county="weld")],
        INCIDENT,
    )
    fact, dims = star(spark, incidents)
    assert fact.count() == incidents.count()
    assert dims["offense"].count() == 3
    by_zip = incidents.join(
        dims["geography"], F.lower(incidents.city_name) == dims["geography"].city_name
    )
    assert by_zip.count() > incidents.count()
    cities = [r.city_geo_key for r in fact.collect()]
    assert len({c for c in cities if c is not None}) == 1
    assert cities.count(None) == 3


def test_rates_do_not_multiply_incidents_by_years(spark):
    incidents = spark.createDataFrame([incident(), incident(), incident("boulder")], INCIDENT)
    fact, dims = star(spark, incidents)
    economy = spark.createDataFrame(
        [("denver", y, 50000 + y, 1000) for y in (2018, 2019, 2020)],
        "county_normalized string, year int, median_household_income bigint, total_population bigint",
    ).select(
        "*",
        *[
            F.lit(None).cast(t).alias(c)
            for c, t in [
                ("per_capita_income", "bigint"),
                ("total_personal_income", "bigint"),
                ("male_population", "bigint"),
                ("female_population", "bigint"),
                ("population_yoy_change", "bigint"),
                ("population_growth_pct", "double"),
            ]
        ],
    )
    income = facts.fct_income_population(economy, dims["geography"])
    tables = {
        "fct_crimes": fact, "dim_geography": dims["geography"], "fct_income_population": income,
    }
    row = portal.crime_density(tables).first()
    assert (row.county_name, row.total_crimes, row.crime_rate_per_100k) == ("Denver", 2, 200.0)

    rate = metrics.query_metrics(
        {"crimes": fact, "income_population": income}, dims,
        ["total_crimes", "crime_rate_per_100k"], ["geo__county_name"],
    )
    found = {r["geo__county_name"]: tuple(r)[1:] for r in rate.collect()}
    assert found == {"denver": (2, 200.0), "boulder": (1, None)}
    with pytest.raises(ValueError, match="not reachable"):
        metrics.query_metrics(
            {"income_population": income}, dims, ["avg_total_population"], ["offense__offense_name"]
        )
    with pytest.raises(ValueError, match="unknown metric"):
        metrics.query_metrics({}, dims, ["no_such_metric"], [])


def test_agency_takes_its_commonest_county(spark):
    data = [incident("weld", agency="x")] * 2 + [incident("adams", agency="x")] * 2
    data += [incident("weld", agency="y"), incident("adams", agency="y"), incident("weld", agency="y")]
    dim = dimensions.dim_agency(spark.createDataFrame(data, INCIDENT))
    assert sorted(map(tuple, dim.collect())) == [("x", "adams", 1), ("y", "weld", 2)]


def test_late_city_comes_from_the_raw_agency_name(spark):
    staged = """agency_name string, county_name string, incident_date date, incident_hour int,
        offense_name string, crime_against string, offense_category_name string, age_num int,
        source_period string"""
    base = ("Weld", dt.date(2020, 1, 5), None, "larceny/THEFT", "Property", "Larceny", None, "p")

    def row(agency, county="Weld", against="Property"):
        return (agency, county, base[1], base[2], base[3], against, base[5], base[6], base[7])

    late = spark.createDataFrame(
        [row("Aurora Police Department"), row("Other"), row(None), row("Aurora", "NOT specified "),
         row("Aurora", against="Not a Crime")],
        staged,
    ).withColumn("offense_group", F.lit("A"))
    early = spark.createDataFrame([row("Park Sheriff")], staged).select(
        "*", F.lit("City").alias("agency_type_name"), F.lit("Fairplay").alias("city_name")
    )
    seed = spark.createDataFrame(
        [("Aurora Police Department", "Aurora")], "pub_agency_name string, city_name string"
    )
    rows = unify.int_crimes_unified(early, late, seed).collect()
    assert {(r.agency_name, r.city_name, r.offense_group) for r in rows} == {
        ("Park", "Fairplay", None), ("Aurora", "Aurora", "A"), ("Other", None, "A"),
    }
    first = rows[0]
    assert (first.offense_name, first.time_of_day, first.day_of_week, first.season) == (
        "Larceny/Theft", "night", 1, "winter",
    )


def test_final_rank_keeps_counties_of_any_leg(spark):
    crime = spark.createDataFrame([("a", 4), ("b", 3)], "county_name string, overall_crime_tier int")
    income = spark.createDataFrame([("b", 2), ("c", 1)], "county string, income_tier int")
    per_capita = spark.createDataFrame([("c", 2), ("d", 4)], "county string, crime_per_capita_tier int")
    ranks = tiers.final_county_tier_rank(crime, income, per_capita)
    assert sorted(map(tuple, ranks.collect())) == [
        ("a", 4, 0, 0, 4), ("b", 3, 2, 0, 3), ("c", 0, 1, 2, 2), ("d", 0, 0, 4, 4),
    ]


def test_calendar(spark):
    dim = dimensions.dim_date(spark)
    assert dim.count() == 10227
    row = dim.where("date_key = '12/31/2023'").first()
    assert (row.day_name, row.is_weekend, row.season, row.week_of_year, row.day_of_year) == (
        "Sunday", True, "winter", 52, 365,
    )


def test_search(spark):
    lookup = spark.createDataFrame(
        [(1, "Acme 42"), (42, "Zeta"), (3, "acme"), (4, None)], "entity_id bigint, entity_name string"
    )

    def found(term, **kw):
        df = portal.search_businesses(lookup, term, **kw)
        return None if df is None else [r.entity_id for r in df.collect()]

    assert found("  ") is None
    assert found(" 42 ") == [42]
    assert found("420") == []
    assert found("ACME") == [1, 3]
    assert found("acme", max_rows=1) == [1]
    assert found("%") == []


def test_metric_groups_add_up_to_the_total(spark):
    """Facts whose county, city or agency is in no dimension are counted under a null."""
    incidents = spark.createDataFrame(
        [incident(), incident(city=None), incident("weld"), incident("weld", agency=None),
         incident("boulder", "Nowhere"), incident(agency="Other", day=dt.date(2020, 1, 4))],
        INCIDENT,
    )
    fact, dims = star(spark, incidents)
    dims["agency"] = dims["agency"].where("agency_name <> 'Other'")

    def counted(group_by, where=None):
        rows = metrics.query_metrics({"crimes": fact}, dims, ["total_crimes"], group_by, where=where)
        return {tuple(r)[:-1]: r["total_crimes"] for r in rows.collect()}

    for group_by in (["geo__county_name"], ["city__city_name"], ["agency__agency_name"],
                     ["geo__county_name", "agency__agency_name", "offense__offense_name"]):
        assert sum(counted(group_by).values()) == counted([])[()] == 6
    assert counted(["geo__county_name"]) == {("denver",): 3, ("boulder",): 1, (None,): 2}
    assert counted(["agency__agency_name"])[(None,)] == 2
    assert counted(["city__city_name"])[(None,)] == 4
    assert counted([], {"geo__county_name": "denver"}) == {(): 3}
    assert sum(counted(["city__city_name"], {"date__is_weekend": True}).values()) == 1
