"""A register of entities and its history, kept by what each landed day changes.

Three tables under ``root``, all derived from the landed days:

- ``current``: the newest row of each entity, laid out by key hash; a day rewrites only the parts
  its entities fall in;
- ``open``: the open version of each entity, laid out alike; a part is rewritten only where a checked
  column changed;
- ``closed``: closed versions by the day they closed; a day adds its own folder and touches no other.

A day that comes after all others is compared with the open versions. A late or corrected day is
redone from the landed rows of just the entities it holds or held: their versions are built again
and replace the old ones. So any order of days gives the same tables. Versions begin and end with
the days, and an entity that a day does not name stays as it is.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaneed.operators.groups import latest_per_key
from areaneed.sources.keyed import (
    PART,
    key_part,
    read_rows,
    replace_folders,
    replace_keys,
    upsert_keyed,
    with_part,
)
from areaneed.sources.scratch import materialise
from areaneed.sources.writers import overwrite_partition

CLOSED_ON = "closed_on"
_SINCE = T.StructType(
    [T.StructField("scd_id", T.StringType()), T.StructField("valid_from", T.TimestampNTZType())]
)
_UNTIL = T.StructField("valid_to", T.TimestampNTZType())


def versions_of(
    log: DataFrame, key: str, day: str, checked: list[str]
) -> DataFrame:
    """Versions from one row per key and day: a row starts one where it is the key's first or a
    checked column differs from the day before (nulls are values). Adds ``scd_id``,
    ``valid_from`` and ``valid_to``; the last version of a key has no end."""
    by_key = Window.partitionBy(key).orderBy(day)
    now, before = F.struct(*checked), F.lag(F.struct(*checked)).over(by_key)
    begins = F.lag(F.lit(True)).over(by_key).isNull() | ~now.eqNullSafe(before)
    since = F.col(day).cast("timestamp_ntz")
    starts = log.withColumn("_begins", begins).where("_begins").drop("_begins")
    return starts.select(
        "*",
        version_id(key, day).alias("scd_id"),
        since.alias("valid_from"),
        F.lead(since).over(by_key).alias("valid_to"),
    )


def version_id(key: str, day: str):
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.col(day).cast("string")))


@dataclass(frozen=True)
class Register:
    """``schema`` is that of landed rows, with the ``day`` column; ``order`` ranks the rows of one key
    and day, the newest highest; ``checked`` are the columns whose change makes a version."""

    spark: SparkSession
    root: str
    schema: T.StructType
    key: str
    order: list[str]
    checked: list[str]
    day: str = "source_date"
    parts: int = 64

    def landed(self) -> DataFrame:
        return read_rows(self.spark, f"{self.root}/landed", self.schema, self.key)

    def current(self) -> DataFrame:
        return self._rows("current", with_part(self.schema)).drop(PART)

    def history(self) -> DataFrame:
        """All versions, the open ones without an end."""
        closed = self._rows("closed", self._closed_schema()).drop(CLOSED_ON)
        return closed.unionByName(
            self._rows("open", with_part(self._open_schema())).drop(PART),
            allowMissingColumns=True,
        )

    def run(self, extract: DataFrame) -> None:
        """Land the days of ``extract`` in place of what these days held, and carry the change on."""
        batch = materialise(extract.select(*self.schema.names), "extract")
        days = [r[0] for r in batch.select(self.day).distinct().collect()]
        landed = self.landed()
        known = {r[0] for r in landed.select(self.day).distinct().collect()}
        held = batch.select(self.key)
        if known.intersection(days):
            held = held.unionByName(landed.where(F.col(self.day).isin(days)).select(self.key))
        held = materialise(held.dropna().distinct(), "held")
        overwrite_partition(batch, f"{self.root}/landed", self.day)
        if len(days) == 1 and all(x < days[0] for x in known):
            self._append(self._newest(batch), days[0])
        elif days:
            self._redo(held)

    def _append(self, rows: DataFrame, day) -> None:
        """The rows of a day after all others."""
        rows = materialise(rows, "day-rows")
        upsert_keyed(rows, f"{self.root}/current", self.key, self.parts)
        numbered = rows.withColumn(PART, key_part(self.key, self.parts))
        touched = [r[0] for r in numbered.select(PART).distinct().collect()]
        old = self._rows("open", with_part(self._open_schema())).where(F.col(PART).isin(touched))
        whole = lambda df: F.struct(*df.columns)
        pairs = numbered.select(PART, self.key, whole(rows).alias("new")).join(
            old.select(PART, self.key, whole(old.drop(PART)).alias("old")),
            [PART, self.key],
            "left",
        )
        same = reduce(
            lambda a, b: a & b,
            [F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in self.checked],
        )
        changed = materialise(pairs.where(F.col("old").isNull() | ~same), "changed")
        ended = changed.where(F.col("old").isNotNull()).select(
            "old.*",
            F.lit(day).cast("timestamp_ntz").alias("valid_to"),
            F.lit(day).alias(CLOSED_ON),
        )
        if not ended.isEmpty():
            replace_folders(ended, f"{self.root}/closed", CLOSED_ON, self.key, [day])
        begun = changed.select("new.*").select(
            "*",
            version_id(self.key, self.day).alias("scd_id"),
            F.col(self.day).cast("timestamp_ntz").alias("valid_from"),
        )
        replace_keys(begun, begun, f"{self.root}/open", self.key, self.parts)

    def _redo(self, keys: DataFrame) -> None:
        """Build the rows and versions of ``keys`` again from all their landed days."""
        log = materialise(self._newest(self.landed().join(keys, self.key, "left_semi")), "log")
        newest = latest_per_key(log, [self.key], self.day)
        replace_keys(newest, keys, f"{self.root}/current", self.key, self.parts)
        versions = materialise(versions_of(log, self.key, self.day, self.checked), "versions")
        still = versions.where("valid_to is null").drop("valid_to")
        replace_keys(still, keys, f"{self.root}/open", self.key, self.parts)
        ended = versions.where("valid_to is not null")
        ended = ended.withColumn(CLOSED_ON, F.col("valid_to").cast("date"))
        closed = self._rows("closed", self._closed_schema())
        before = closed.join(keys, self.key, "left_semi")
        days = before.select(CLOSED_ON).union(ended.select(CLOSED_ON)).distinct().collect()
        days = sorted(r[0] for r in days)
        kept = closed.where(F.col(CLOSED_ON).isin(days)).join(keys, self.key, "left_anti")
        replace_folders(
            kept.unionByName(ended), f"{self.root}/closed", CLOSED_ON, self.key, days
        )

    def _newest(self, rows: DataFrame) -> DataFrame:
        first, *ties = self.order
        return latest_per_key(rows, [self.day, self.key], first, ties)

    def _rows(self, table: str, schema: T.StructType) -> DataFrame:
        return read_rows(self.spark, f"{self.root}/{table}", schema, self.key)

    def _open_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, *_SINCE.fields])

    def _closed_schema(self) -> T.StructType:
        closed_on = T.StructField(CLOSED_ON, T.DateType())
        return T.StructType([*self._open_schema().fields, _UNTIL, closed_on])
