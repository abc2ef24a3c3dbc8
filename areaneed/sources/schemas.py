"""Declared table schemas, and the check that a result keeps to one."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "id38": T.DecimalType(38, 0),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _schema(columns: str) -> T.StructType:
    """'name type, name type' as a schema; needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


# Column names and types of the seed and raw inputs.
ZIP_SEED = _schema("zip_code int, city string, county string")
CENTROID_SEED = _schema("county string, label string, cent_lat double, cent_long double")
AGENCY_CITY_SEED = _schema("pub_agency_name string, city_name string")

RAW_ENTITY = _schema(
    """entityid string, entityname string, principaladdress1 string, principaladdress2 string,
    principalcity string, principalstate string, principalzipcode string,
    principalcountry string, entitystatus string, jurisdictonofformation string,
    entitytype string, entityformdate string"""
)

LANDED_ENTITY = T.StructType(
    [
        *RAW_ENTITY.fields,
        *_schema("_ingested_at timestamp_ntz, _source_date date, source_date date").fields,
    ]
)

# The eight declared lake tables.
RAW_INCIDENT_TABLE = _schema(
    """pub_agency_name string, county_name string, incident_date string, incident_hour int,
    offense_name string, crime_against string, offense_category_name string,
    offense_group string, age_num int"""
)
ENTITY_TABLE = _schema(
    """entityid id38, entityname string, principaladdress1 string,
    principaladdress2 string, principalcity string, principalcounty string,
    principalstate string, principalzipcode string, principalcountry string,
    entitystatus string, jurisdictonofformation string, entitytype string,
    entityformdate date"""
)
GEOCODED_ENTITY_TABLE = _schema(
    """entityid id38, principaladdress1 string, principalcity string,
    principalzipcode string, full_address string, geo_city string, geo_county string,
    geo_state string, geo_postcode string"""
)
CLEAN_INCIDENT_TABLE = _schema(
    """agency_name string, county_name string, incident_date date, incident_hour int,
    offense_name string, crime_against string, offense_category_name string, age_num int,
    cleaned_at timestamp_ntz"""
)
CLEAN_ENTITY_TABLE = _schema(
    """entityid id38, entityname string, principaladdress1 string,
    principalcity string, principalcounty string, principalstate string,
    principalzipcode string, entitystatus string, entitytype string, entityformdate date,
    cleaned_at timestamp_ntz"""
)
COUNTY_MONTH_TABLE = _schema(
    """county_name string, year int, month int, total_crimes bigint, crimes_per_100k double,
    avg_age double, top_offense_category string"""
)
TIER_RANKING_TABLE = _schema(
    """county_name string, year int, crime_score int, income_score int, population_score int,
    overall_tier string, tier_rank int"""
)
CITY_SEASON_TABLE = _schema(
    """city_name string, season string, year int, avg_crimes_per_day double,
    peak_crime_hour int, top_offense_type string"""
)

# Enforced contracts of the dimension, fact and report tables.
DIM_DATE = _schema(
    """date_day date, full_date string, date_key string, year int, quarter int, month int,
    month_name string, day_of_month int, day_of_week int, day_name string, day_of_year int,
    week_of_year int, season string, is_weekend boolean"""
)
DIM_GEOGRAPHY = _schema(
    """city_name string, county_name string, zip_code string, cent_lat double,
    cent_long double, state string, geo_key bigint"""
)
DIM_OFFENSE = _schema(
    """offense_category_name string, offense_name string, crime_against string,
    offense_key bigint, offense_group string"""
)
DIM_AGENCY = _schema("agency_name string, primary_county string, agency_key bigint")
DIM_BUSINESS = _schema(
    """business_key string, business_scd_id string, entity_id bigint, entity_name string,
    principal_address_1 string, principal_city string, principal_county string,
    principal_state string, principal_zip string, entity_status string, entity_type string,
    formation_date date, jurisdiction string, is_eligible boolean, is_current boolean,
    valid_from timestamp_ntz, valid_to timestamp_ntz, dw_updated_at timestamp_ntz"""
)
FCT_CRIMES = _schema(
    """incident_date date, incident_hour int, time_of_day string, age_num int,
    source_period string, date_key string, geo_key bigint, city_geo_key bigint,
    offense_key bigint, agency_key bigint, crime_count int"""
)
FCT_INCOME_POPULATION = _schema(
    """geo_key bigint, year int, year_date date, median_household_income bigint,
    per_capita_income bigint, total_personal_income bigint, total_population bigint,
    male_population bigint, female_population bigint, population_yoy_change bigint,
    population_growth_pct double"""
)
FCT_BUSINESS = _schema(
    """business_key string, entity_id bigint, entity_name string, principal_city string,
    principal_county string, principal_zip string, entity_type string, formation_date date,
    geo_key bigint, crime_tier int, income_tier int, population_tier int, composite_tier int,
    qualifies_for_subsidy boolean, subsidy_tier_label string, notification_eligible boolean"""
)
RPT_AGENCY_BASELINE = _schema(
    """county_name string, agency_name string, total_crimes bigint,
    target_crimes_5pct_reduction bigint, first_incident_date date, last_incident_date date"""
)
RPT_BUSINESS_TIER_LOOKUP = _schema(
    """entity_id bigint, entity_name string, principal_city string, principal_county string,
    principal_zip string, entity_type string, formation_date date, crime_tier int,
    income_tier int, population_tier int, composite_tier int, subsidy_tier_label string,
    qualifies_for_subsidy boolean, notification_eligible boolean, subsidy_message string"""
)

DECLARED = {
    "raw_incidents": RAW_INCIDENT_TABLE,
    "entities": ENTITY_TABLE,
    "geocoded_entities": GEOCODED_ENTITY_TABLE,
    "clean_incidents": CLEAN_INCIDENT_TABLE,
    "clean_entities": CLEAN_ENTITY_TABLE,
    "county_month": COUNTY_MONTH_TABLE,
    "tier_rankings": TIER_RANKING_TABLE,
    "city_season": CITY_SEASON_TABLE,
}

CONTRACTS = {
    "dim_date": DIM_DATE,
    "dim_geography": DIM_GEOGRAPHY,
    "dim_offense": DIM_OFFENSE,
    "dim_agency": DIM_AGENCY,
    "dim_business": DIM_BUSINESS,
    "fct_crimes": FCT_CRIMES,
    "fct_income_population": FCT_INCOME_POPULATION,
    "fct_business_subsidy_tiers": FCT_BUSINESS,
    "rpt_agency_baseline": RPT_AGENCY_BASELINE,
    "rpt_business_tier_lookup": RPT_BUSINESS_TIER_LOOKUP,
}
