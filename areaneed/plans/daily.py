"""The daily run: land a day, check it, upsert the register, record its history.

Rerunning a day gives the same tables: landing replaces the day, and each table state
is a version of its own, numbered by the day and read only when complete.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from areaneed.constants import VERSIONED_COLUMNS
from areaneed.operators.groups import latest_per_key
from areaneed.operators.merge import empty_history, scd2_snapshot, upsert_by_key
from areaneed.plans.staging import snapshot_input
from areaneed.sources.readers import add_audit_columns, read_landed
from areaneed.sources.schemas import LANDED_ENTITY
from areaneed.sources.scratch import materialise
from areaneed.sources.versions import committed, read_version, write_version
from areaneed.sources.writers import NoRowsLanded, assert_rows_landed, overwrite_partition

KEY = "entityid"


def _number(day: dt.date) -> int:
    return int(day.strftime("%Y%m%d"))


def _before(spark: SparkSession, root: str, day: dt.date) -> DataFrame | None:
    """The newest complete version from before ``day``."""
    earlier = [n for n in committed(spark, root) if n < _number(day)]
    return read_version(spark, root, earlier[-1]) if earlier else None


def land_day(extract: DataFrame, root: str, day: dt.date, ingested_at: dt.datetime) -> bool:
    """Replace the day's landed rows; an empty extract changes nothing."""
    batch = add_audit_columns(extract, day, ingested_at)
    batch = batch.withColumn("source_date", F.col("_source_date"))
    return overwrite_partition(batch, f"{root}/landed")


def merge_day(spark: SparkSession, root: str, day: dt.date) -> DataFrame:
    """Upsert the day's newest row per entity into the register."""
    landed = _landed(spark, root, day)
    audit = ["_ingested_at", "_source_date", "source_date"]
    data = [c for c in landed.columns if c not in [KEY, *audit]]
    newest = latest_per_key(landed, [KEY], "_ingested_at", data).drop(*audit)
    register = _before(spark, f"{root}/register", day)
    if register is not None:
        newest = materialise(newest, "newest")  # read more than once below
        newest = upsert_by_key(register, newest, [KEY])
    return write_version(newest, f"{root}/register", _number(day))


def _landed(spark: SparkSession, root: str, day: dt.date) -> DataFrame:
    """The day's landed rows, or ``NoRowsLanded``, also when nothing was ever landed."""
    try:
        landed = read_landed(spark, f"{root}/landed", day, LANDED_ENTITY)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise NoRowsLanded(f"no rows landed for {day}") from error
    return assert_rows_landed(landed, day)


def snapshot_day(spark: SparkSession, root: str, day: dt.date, run_ts: dt.datetime) -> DataFrame:
    """Compare the register with its history and write the new history."""
    current = snapshot_input(read_version(spark, f"{root}/register", _number(day)))
    history = _before(spark, f"{root}/history", day)
    if history is None:
        history = empty_history(current)
    updated = scd2_snapshot(history, current, "entity_id", VERSIONED_COLUMNS, run_ts)
    return write_version(updated, f"{root}/history", _number(day))


def run_day(
    spark: SparkSession,
    extract: DataFrame,
    root: str,
    day: dt.date,
    ingested_at: dt.datetime,
) -> DataFrame:
    """Land, check, merge and snapshot one day; returns the newest history.

    Days that came before a late or corrected one are merged again on top of it, each at its
    own load time, so the order in which days are landed makes no difference.
    """
    land_day(extract, root, day, ingested_at)
    merge_day(spark, root, day)
    history = snapshot_day(spark, root, day, ingested_at)
    for number in committed(spark, f"{root}/register", after=_number(day)):
        later = dt.datetime.strptime(str(number), "%Y%m%d").date()
        loaded = _landed(spark, root, later).agg(F.max("_ingested_at")).first()[0]
        merge_day(spark, root, later)
        history = snapshot_day(spark, root, later, loaded)
    return history
