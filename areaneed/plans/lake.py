"""The five declared lake tables between the raw inputs and the models, each to its schema.

Texts that do not parse become null; no row is dropped but where a table's name says so.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaneed.constants import HOME_STATE_CODE
from areaneed.functions.text import clean_key, clean_zip
from areaneed.operators.groups import first_of_group
from areaneed.sources import schemas


def _to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in their order and types; a value that does not fit is null."""
    return df.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def _by_zip(zip_lookup: DataFrame) -> DataFrame:
    """One row per zip code: its first city and county."""
    first = first_of_group(zip_lookup, ["zip_code"], [F.col("city"), F.col("county")])
    return first.select(
        F.col("zip_code").alias("_zip"),
        F.col("city").alias("geo_city"),
        F.col("county").alias("geo_county"),
    )


def raw_incident_table(early: DataFrame, late: DataFrame) -> DataFrame:
    """Incidents of both periods under one set of names, as they came."""
    named = early.withColumnsRenamed(
        {"agency_name": "pub_agency_name", "primary_county": "county_name"}
    )
    rows = late.unionByName(named, allowMissingColumns=True)
    return _to_schema(rows, schemas.RAW_INCIDENT_TABLE)


def entity_table(register: DataFrame, zip_lookup: DataFrame) -> DataFrame:
    """The register with the county of each entity's zip code."""
    keyed = register.withColumn("_zip", clean_zip(F.col("principalzipcode")))
    rows = keyed.join(_by_zip(zip_lookup), "_zip", "left")
    return _to_schema(
        rows.withColumnRenamed("geo_county", "principalcounty"), schemas.ENTITY_TABLE
    )


def geocoded_entity_table(entities: DataFrame, zip_lookup: DataFrame) -> DataFrame:
    """Entities with one line of address and the place of their zip code, null if it has none."""
    keyed = entities.withColumn("_zip", clean_zip(F.col("principalzipcode")))
    rows = keyed.join(_by_zip(zip_lookup), "_zip", "left")
    found = F.col("geo_city").isNotNull()
    place = F.concat_ws(" ", "principalstate", "_zip")
    rows = rows.withColumns(
        {
            "full_address": F.concat_ws(", ", "principaladdress1", "principalcity", place),
            "geo_state": F.when(found, F.col("principalstate")),
            "geo_postcode": F.when(found, F.col("_zip")),
        }
    )
    return _to_schema(rows, schemas.GEOCODED_ENTITY_TABLE)


def clean_incident_table(incidents: DataFrame, cleaned_at: dt.datetime | str) -> DataFrame:
    """The unified incidents, as cleaned at a time."""
    return _to_schema(
        incidents.withColumn("cleaned_at", _time(cleaned_at)), schemas.CLEAN_INCIDENT_TABLE
    )


def clean_entity_table(
    entities: DataFrame, cleaned_at: dt.datetime | str, state: str = HOME_STATE_CODE
) -> DataFrame:
    """Entities of the home state with a well-formed zip code, names of places in one spelling."""
    rows = entities.withColumns(
        {
            "principalzipcode": clean_zip(F.col("principalzipcode")),
            "principalcity": clean_key(F.col("principalcity")),
            "cleaned_at": _time(cleaned_at),
        }
    )
    rows = rows.where((F.col("principalstate") == state) & F.col("principalzipcode").isNotNull())
    return _to_schema(rows, schemas.CLEAN_ENTITY_TABLE)


def _time(at: dt.datetime | str) -> Column:
    return F.lit(str(at)).cast("timestamp_ntz")
