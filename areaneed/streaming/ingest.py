"""Continuous ingest: landed files, newest row per key, upsert.

Each micro-batch is reduced to its newest row per key and written as one folder named
by the batch number, so a replayed batch replaces itself. The cost of a batch follows
its own size, never the size of the target. Readers upsert the newest row per key of
the batches over the base; ``compact`` writes that state as the next base.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from areaneed.operators.groups import latest_per_key
from areaneed.operators.merge import upsert_by_key
from areaneed.sources.versions import committed, read_version, write_version


def _write_batch(batch: DataFrame, batch_id: int, target: str, latest) -> None:
    latest(batch).write.mode("overwrite").parquet(f"{target}/changes/batch={batch_id}")


def stream_ingest(
    spark: SparkSession,
    in_dir: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    keys: list[str],
    order_col: str,
    ties: list[str] | None = None,
    files_per_batch: int | None = None,
) -> None:
    """Take in all files that arrived since the last run, then stop."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    latest = partial(latest_per_key, keys=keys, order_col=order_col, ties=ties)
    query = (
        reader.parquet(in_dir)
        .writeStream.foreachBatch(partial(_write_batch, target=target, latest=latest))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def current_state(
    spark: SparkSession,
    target: str,
    keys: list[str],
    order_col: str,
    ties: list[str] | None = None,
) -> DataFrame | None:
    """The target as of the last complete batch; an update older than the row loses.

    Base and batches are ranked by one order (``order_col``, then ``ties``), so a compaction
    never changes the answer. Only the batches since the base are looked at.
    """
    base_root = f"{target}/base"
    done = committed(spark, base_root)
    since = done[-1] if done else -1
    base = read_version(spark, base_root)
    batches = committed(spark, f"{target}/changes", "batch", since)
    if not batches:
        return base
    changes = spark.read.parquet(*[f"{target}/changes/batch={b}" for b in batches])
    newest = latest_per_key(changes, keys, order_col, ties)
    order = [order_col, *(ties or [])]
    return newest if base is None else upsert_by_key(base, newest, keys, newer_by=order)


def compact(
    spark: SparkSession,
    target: str,
    keys: list[str],
    order_col: str,
    ties: list[str] | None = None,
) -> DataFrame | None:
    """Write the current state as a base that covers every batch so far."""
    done = committed(spark, f"{target}/base")
    batches = committed(spark, f"{target}/changes", "batch", done[-1] if done else -1)
    if not batches:
        return read_version(spark, f"{target}/base")
    state = current_state(spark, target, keys, order_col, ties)
    return write_version(state, f"{target}/base", batches[-1])
