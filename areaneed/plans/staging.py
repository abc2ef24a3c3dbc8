"""Staging: rename, type and filter one raw table each. All are scans with pushed filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaneed.constants import (
    COUNTY_AREA_TYPE,
    EARLY_PERIOD,
    HOME_STATE,
    HOME_STATE_CODE,
    LATE_PERIOD,
)
from areaneed.functions.calendar import parse_us_date
from areaneed.functions.text import clean_key, to_whole_number

# Raw column -> staged column of a registered entity.
ENTITY_COLUMNS = {
    "entityid": "entity_id",
    "entityname": "entity_name",
    "principaladdress1": "principal_address_1",
    "principaladdress2": "principal_address_2",
    "principalcity": "principal_city",
    "principalstate": "principal_state",
    "principalzipcode": "principal_zip_code",
    "principalcountry": "principal_country",
    "entitystatus": "entity_status",
    "jurisdictonofformation": "jurisdiction_of_formation",
    "entitytype": "entity_type",
    "entityformdate": "entity_form_date",
}

# The entity columns whose history is kept.
HISTORY_COLUMNS = [
    "entity_id",
    "entity_name",
    "entity_status",
    "entity_type",
    "entity_form_date",
    "jurisdiction_of_formation",
    "principal_address_1",
    "principal_city",
    "principal_state",
    "principal_zip_code",
]


def _entities(raw: DataFrame) -> DataFrame:
    return raw.select(*[F.col(r).alias(s) for r, s in ENTITY_COLUMNS.items()]).withColumn(
        "entity_form_date", F.col("entity_form_date").cast("date")
    )


def stg_business_entities(raw: DataFrame, state: str = HOME_STATE_CODE) -> DataFrame:
    """Entities of the home state."""
    return _entities(raw).where(F.col("principal_state") == state)


def snapshot_input(raw: DataFrame) -> DataFrame:
    """What the entity history compares: all states, only the columns it keeps."""
    return _entities(raw).select(
        F.col("entity_id").cast("bigint").alias("entity_id"), *HISTORY_COLUMNS[1:]
    )


def stg_snapshot(history: DataFrame) -> DataFrame:
    """History columns in their declared order."""
    return history.select("scd_id", "valid_from", "valid_to", *HISTORY_COLUMNS)


def _incidents(raw: DataFrame, agency: str, county: str, own: list[str], period: str) -> DataFrame:
    typed = raw.select(
        F.col(agency).alias("agency_name"),
        F.col(county).alias("county_name"),
        parse_us_date(F.col("incident_date")).alias("incident_date"),
        F.col("incident_hour").cast("int").alias("incident_hour"),
        "offense_name",
        "crime_against",
        "offense_category_name",
        F.col("age_num").cast("int").alias("age_num"),
        *own,
        F.lit(period).alias("source_period"),
    )
    # A row without agency, category and date would fall to the date test as well.
    return typed.where(F.col("county_name").isNotNull() & F.col("incident_date").isNotNull())


def stg_crimes_1997_2015(raw: DataFrame) -> DataFrame:
    """Early period: carries a city, no offense group."""
    own = ["agency_type_name", "city_name"]
    return _incidents(raw, "agency_name", "primary_county", own, EARLY_PERIOD)


def stg_crimes_2016_2020(raw: DataFrame) -> DataFrame:
    """Late period: carries an offense group, no city."""
    return _incidents(raw, "pub_agency_name", "county_name", ["offense_group"], LATE_PERIOD)


def stg_income(raw: DataFrame, state: str = HOME_STATE) -> DataFrame:
    """County rows of the home state, numbers without thousands commas."""
    return raw.where(
        (F.col("statename") == state) & (F.col("areatype") == COUNTY_AREA_TYPE)
    ).select(
        F.col("statename").alias("state_name"),
        F.col("areaname").alias("county"),
        F.col("periodyear").cast("int").alias("year"),
        F.col("inctype").cast("int").alias("income_type_code"),
        F.col("incdesc").alias("income_description"),
        to_whole_number(F.col("income")).alias("income"),
        to_whole_number(F.col("population")).alias("population"),
    )


def stg_population(raw: DataFrame) -> DataFrame:
    """Age rows with people in them."""
    return (
        raw.where(F.col("county").isNotNull())
        .select(
            "county",
            F.col("year").cast("int").alias("year"),
            F.col("age").cast("int").alias("age"),
            to_whole_number(F.col("malepopulation")).alias("male_population"),
            to_whole_number(F.col("femalepopulation")).alias("female_population"),
            to_whole_number(F.col("totalpopulation")).alias("total_population"),
            F.col("datatype").alias("data_type"),
            F.col("fipscode").cast("int").alias("fips_code"),
        )
        .where(F.col("total_population") > 0)
    )


def stg_city_county_zip(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("zip_code").cast("string").alias("zip_code"),
        clean_key(F.col("city")).alias("city"),
        clean_key(F.col("county")).alias("county"),
    )


def stg_county_boundaries(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.upper(F.trim("county")).alias("county_code"),
        F.trim("label").alias("county_label"),
        F.col("cent_lat").cast("double").alias("cent_lat"),
        F.col("cent_long").cast("double").alias("cent_long"),
    )
