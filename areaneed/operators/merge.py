"""Upsert and entity history."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from areaneed.sources.scratch import materialise


def upsert_by_key(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    newer_by: str | list[str] | None = None,
) -> DataFrame:
    """Matched rows take every value of ``source`` (nulls too), unmatched ones are added.

    ``source`` has one row per key. The target is not shuffled when the day's batch is
    small enough to broadcast: matched rows come from a left join, and new ones from
    an anti join against just those target keys the batch contains. Columns only the
    target has are kept for matched rows and null for added ones. With ``newer_by`` (a time, and
    columns that decide between equal times, highest first) a matched row is only replaced
    when it does not come later than the batch's; a null comes first. ``source`` is read
    twice and ``target`` too, so hand in written tables.
    """
    source = source.dropna(subset=keys)
    shared = [c for c in target.columns if c in source.columns and c not in keys]
    batch = source.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in shared])
    batch = batch.withColumn("_hit", F.lit(True))
    take = F.col("_hit")
    if newer_by is not None:
        order = [newer_by] if isinstance(newer_by, str) else newer_by
        own = F.struct(*[F.col(c).alias(c) for c in order])
        take = take & (F.struct(*[F.col(f"_new_{c}").alias(c) for c in order]) >= own)
    updated = target.join(batch, keys, "left").select(
        *[
            F.when(take, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in shared
            else F.col(c)
            for c in target.columns
        ]
    )
    known = target.select(*keys).join(source.select(*keys), keys, "left_semi")
    added = source.join(known, keys, "left_anti").select(*keys, *shared)
    return updated.unionByName(added, allowMissingColumns=True).select(*target.columns)


SCD_COLUMNS = ["scd_id", "valid_from", "valid_to"]


def empty_history(current: DataFrame) -> DataFrame:
    """A history without versions, for the first run."""
    return current.limit(0).select(
        "*",
        F.lit(None).cast("string").alias("scd_id"),
        F.lit(None).cast("timestamp_ntz").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )


def scd2_snapshot(
    history: DataFrame,
    current: DataFrame,
    key: str,
    check_cols: list[str],
    run_ts: dt.datetime | str,
) -> DataFrame:
    """Compare open versions with ``current`` and record what changed at ``run_ts``.

    A change in any checked column (null-safe) closes the open version and opens a new
    one; a key that is gone is closed; a new or returned key is opened. Closed
    versions pass through without a shuffle. Both join sides have one row per key.
    """
    now = F.lit(str(run_ts)).cast("timestamp_ntz")
    data = [c for c in history.columns if c not in SCD_COLUMNS]
    closed = history.where(F.col("valid_to").isNotNull())
    old = history.where(F.col("valid_to").isNull()).withColumn("_open", F.lit(True)).alias("o")
    new = current.dropna(subset=[key]).withColumn("_seen", F.lit(True)).alias("n")
    pairs = old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")

    same = reduce(
        lambda a, b: a & b, [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in check_cols]
    )
    unchanged = F.col("_open") & F.col("_seen") & same
    keep = F.coalesce(unchanged, F.lit(False))

    def version(side: str, scd_id, valid_from, valid_to):
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in data],
            scd_id.alias("scd_id"),
            valid_from.alias("valid_from"),
            valid_to.alias("valid_to"),
        )

    kept_or_closed = F.when(
        F.col("_open"),
        version("o", F.col("o.scd_id"), F.col("o.valid_from"), F.when(~keep, now)),
    )
    fresh_id = F.md5(
        F.concat_ws("|", F.col(f"n.{key}").cast("string"), F.date_format(now, _SECONDS))
    )
    opened = F.when(
        F.col("_seen") & ~keep, version("n", fresh_id, now, F.lit(None).cast("timestamp_ntz"))
    )
    versions = pairs.select(
        F.explode(F.array_compact(F.array(kept_or_closed, opened))).alias("v")
    ).select("v.*")
    return closed.select(*data, *SCD_COLUMNS).unionByName(versions)


_SECONDS = "yyyy-MM-dd HH:mm:ss"


def scd2_as_of(history: DataFrame, ts: dt.datetime | str) -> DataFrame:
    """The version of each key that was valid at ``ts`` (start inclusive, end exclusive)."""
    at = F.lit(str(ts)).cast("timestamp_ntz")
    return history.where(
        (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at))
    )


def scd2_at_events(
    events: DataFrame, history: DataFrame, key: str, event_ts: str, columns: list[str]
) -> DataFrame:
    """Each event with ``columns`` of the version valid at its time, null when there is none.

    An as-of merge: versions and events are sorted together by key and time, and each event takes the
    last version before it, so the work grows with versions plus events, never with their
    product. The sort is by ranges of key, time and row, so a key with a third of the events, or all
    events of one moment, are spread over many tasks; where a range begins in the middle of a key, the
    last version of the ranges before is handed on, one row a range. Versions of one key do not
    overlap. Events with a null key or time get nulls; versions with a null key are left out.
    """
    version = F.struct(F.col("valid_to").alias("_until"), *columns)
    begun = history.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull()).select(
        F.col(key).alias("_key"), F.col("valid_from").alias("_at"), version.alias("_version")
    )
    asked = events.select(
        F.col(key).alias("_key"),
        F.col(event_ts).cast("timestamp_ntz").alias("_at"),
        F.struct(*events.columns).alias("_event"),
    )
    # Nulls come first: of one moment, versions before events.
    order = ["_key", "_at", F.col("_event").isNotNull(), F.xxhash64("_event")]
    both = begun.unionByName(asked, allowMissingColumns=True)
    ranges = both.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    rows = materialise(ranges, "as-of")
    # One row a range: there are as many as shuffle partitions.
    place = F.struct("_key", "_at")
    last = rows.where("_version is not null").groupBy("_range").agg(
        F.max_by(F.struct("_key", "_version"), place).alias("_last")
    )
    before = Window.partitionBy(F.lit(1)).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    handed = (
        rows.select("_range").distinct().join(last, "_range", "left")
        .select("_range", F.last("_last", ignorenulls=True).over(before).alias("_handed"))
    )
    here = Window.partitionBy("_range", "_key").orderBy("_at", F.col("_event").isNotNull())
    found = F.last("_version", ignorenulls=True).over(
        here.rowsBetween(Window.unboundedPreceding, 0)
    )
    merged = rows.withColumn("_found", found).where("_event is not null")
    merged = merged.join(F.broadcast(handed), "_range")
    same_key = F.col("_handed._key") == F.col("_key")
    valid = F.coalesce("_found", F.when(same_key, F.col("_handed._version")))
    valid = F.when(
        F.col("_at").isNotNull() & (valid["_until"].isNull() | (valid["_until"] > F.col("_at"))),
        valid,
    )
    merged = merged.withColumn("_valid", valid)
    return merged.select(
        *[F.col(f"_event.`{c}`").alias(c) for c in events.columns],
        *[F.col(f"_valid.`{c}`").alias(c) for c in columns],
    )
