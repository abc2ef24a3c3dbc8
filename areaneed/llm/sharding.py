"""Two-pass external shuffle into training shards, in DataFrame functions only.

Pass 1 scatters the rows: a row's shard follows from its id and the number of shards, and a seeded
hash of the row's place spreads each shard evenly over buckets of a size that one task can hold.
Pass 2 gathers each bucket and puts its rows in a Fisher-Yates order (Spark's ``shuffle`` of
an array) before it is written. The places of a bucket in its shard follow from the counts
of the buckets before it, one row a bucket.

Law of the shards, ``key``: a row goes to the shard with the largest hash of (id, shard). One more
shard changes nothing among the others: it takes the rows whose hash it tops, into itself only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areaneed.sources.scratch import materialise, scratch_path

LAW = "key"


def shard_of(key: Column, shards: int, seed: int = 0) -> Column:
    """The shard with the largest hash of the key and its number (ties: the larger number)."""
    scores = [
        F.struct(F.xxhash64(F.lit(seed), key, F.lit(i)).alias("h"), F.lit(i).alias("shard"))
        for i in range(shards)
    ]
    return F.array_max(F.array(*scores))["shard"]


def shuffle_shards(
    docs: DataFrame,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 24,
    bucket_bytes: int = 16 << 20,
    seed: int = 0,
) -> DataFrame:
    """Write the shards under ``path`` (by default in the shared folder) and return their rows.

    Adds ``size`` (UTF-8 bytes of the text, 8 more), ``shard``, ``slot`` (the row's place in its
    shard, from 0 without gaps) and ``grown_shard`` (the shard if there were one more). The files
    lie in one folder a shard; ``slot`` is derived from the bucket and place they hold.

    A null text has no bytes. Null ids are one key, as any id that many rows have: such rows share
    a shard but are spread over its buckets. Other columns pass through; input columns named like the
    added ones (or ``bucket`` and ``place``) are replaced. An empty table writes no rows. The order
    is the same whenever the rows are read in the same splits and shuffled into the same partitions;
    the shards are the same in any case.
    """
    new = ["size", "shard", "bucket", "place", "slot", "grown_shard"]
    keep = [c for c in docs.columns if c not in new]
    path = path or scratch_path(docs.sparkSession, "shards")
    text = F.col(f"`{text_col}`").cast("string")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")
    total = docs.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, -(-total // (shards * bucket_bytes)))

    key = F.col(f"`{id_col}`")
    spread = F.xxhash64(F.lit(seed + 1), key, F.col("rid"))
    scattered = (
        docs.select(*[F.col(f"`{c}`") for c in keep])
        .withColumn("rid", F.monotonically_increasing_id())
        .select(
            shard_of(key, shards, seed).alias("shard"),
            F.pmod(spread, F.lit(buckets)).alias("bucket"),
            F.struct(
                F.col("rid"),
                size.alias("size"),
                shard_of(key, shards + 1, seed).alias("grown_shard"),
                F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
            ).alias("r"),
        )
        .repartition("shard", "bucket")
    )
    # Sorted by the unique row number first, so a task that is run again deals the same order.
    gathered = scattered.groupBy("shard", "bucket").agg(
        F.sort_array(F.collect_list("r")).alias("rows")
    )
    dealt = gathered.select(
        "shard", "bucket", F.posexplode(F.shuffle("rows", seed)).alias("place", "r")
    ).select("shard", "bucket", "place", "r.size", "r.grown_shard", "r.row")
    dealt.write.partitionBy("shard").parquet(path)
    return read_shards(docs, path, dealt.schema)


def read_shards(docs: DataFrame, path: str, schema) -> DataFrame:
    """The rows of written shards with their slots.

    The first slots, one row a bucket, are written: their files are small, so the rows
    meet them without a shuffle of the texts.
    """
    rows = docs.sparkSession.read.schema(schema).parquet(path)
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    first = (
        rows.groupBy("shard", "bucket")
        .agg(F.count("*").alias("n"))
        .select(
            "shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_slot")
        )
    )
    first = materialise(first, "first-slots")
    return rows.join(first, ["shard", "bucket"]).select(
        "row.*", "size", "shard", (F.col("first_slot") + F.col("place")).alias("slot"), "grown_shard"
    )
