"""Exact duplicates with a heavy-hitter split.

1. Only (id, row, digest of the normalised text) is written once; texts are read in that one pass.
2. Misra-Gries: each task keeps at most ``counters`` digests with lower bounds of their counts.
   The bounds of all tasks add up, and each digest with more than 2 / (counters + 1) of the rows
   reaches 1 / (counters + 1) of them there, which at most ``counters`` + 1 digests can.
3. Verification: those candidates are counted exactly, with the first row of each. The verified
   winners, ``counters`` + 1 rows at most, are broadcast: rows with such a digest are decided in the map
   tasks, however many they are.
4. All other digests are grouped by an ordinary shuffle, in which no key has more than
   2 / (counters + 1) of the rows.

Equality is that of SHA-256 digests of the normalised texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaneed.sources.scratch import materialise

#: White space in which equal texts may differ.
BLANKS = r"[\x20\x09-\x0D]+"


def text_digest(text: Column) -> Column:
    """SHA-256 of a text with each run of white space as one space; a null is an empty text."""
    spaced = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, " ")
    return F.unhex(F.sha2(spaced, 256))


def mark_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = 1024
) -> DataFrame:
    """One row per row of ``docs``: its id, ``keep_id``, ``group_size``, ``kept`` and ``digest``.

    Of rows with equal texts the one with the smallest id stays, and ``keep_id`` is its id. A null
    text equals an empty one; a text of blanks alone equals one space, not an empty text. A null id
    comes after every other, so ``keep_id`` is null only in groups without any id. Where
    several rows hold both the text and its smallest id, exactly one of them is ``kept``. Other
    columns are not read. An empty table gives an empty result.
    """
    rows, winners, groups = _decided(docs, id_col, text_col, counters)
    decided = rows.join(F.broadcast(winners), "digest")
    ordinary = rows.join(F.broadcast(winners), "digest", "left_anti").join(groups, "digest", "left")
    alone = F.col("first").isNull()
    return decided.unionByName(ordinary).select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("first.row") == F.col("row"))).alias("kept"),
        "digest",
    )


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = 1024
) -> DataFrame:
    """The rows of ``docs`` that ``mark_copies`` keeps, with all their columns.

    Copies of frequent texts go in the map tasks. Texts that occur once are shuffled only if the
    list of repeated digests is too large to broadcast; Spark decides that by its measured size. Of
    rows that share text and id any one stays.
    """
    _, winners, groups = _decided(docs, id_col, text_col, counters)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    own = F.col(f"`{id_col}`").cast("long")
    rows = docs.select(
        F.struct(*columns).alias("doc"),
        own.alias("id"),
        text_digest(F.col(f"`{text_col}`")).alias("digest"),
    )
    known = winners.withColumnRenamed("first", "often").drop("group_size")
    rows = rows.join(F.broadcast(known), "digest", "left")
    rows = rows.where(F.col("often").isNull() | F.col("often.id").eqNullSafe(F.col("id")))
    rows = rows.join(groups.drop("group_size"), "digest", "left")
    first = F.coalesce("often", "first")
    alone = rows.where(first.isNull())
    firsts = rows.where(first.isNotNull() & first["id"].eqNullSafe(F.col("id")))
    return alone.unionByName(firsts.dropDuplicates(["digest"])).select("doc.*")


def _decided(
    docs: DataFrame, id_col: str, text_col: str, counters: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows' digests; first row and size of each frequent digest; those of all other digests
    that occur more than once."""
    if counters < 1:
        raise ValueError("counters must be at least 1")
    rows = materialise(
        docs.select(
            F.col(f"`{id_col}`").cast("long").alias("id"),
            text_digest(F.col(f"`{text_col}`")).alias("digest"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "exact-digests",
    )
    bounds = rows.select("digest").mapInArrow(
        partial(_frequent, counters=counters), "digest binary, n long"
    )
    least = F.col("n") * (counters + 1) >= F.lit(rows.count())
    candidates = bounds.groupBy("digest").agg(F.sum("n").alias("n")).where(least).select("digest")
    # Counters + 1 rows at most, by the bound above; so are the winners.
    winners = _groups(rows.join(F.broadcast(materialise(candidates, "exact-candidates")), "digest"))
    winners = materialise(winners, "exact-winners")
    rest = rows.join(F.broadcast(winners), "digest", "left_anti")
    return rows, winners, _groups(rest).where("group_size > 1")


def _groups(rows: DataFrame) -> DataFrame:
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    return rows.groupBy("digest").agg(
        F.count("*").alias("group_size"), F.min(order).alias("first")
    )


def _frequent(batches: Iterator[pa.RecordBatch], counters: int) -> Iterator[pa.RecordBatch]:
    """Misra-Gries over a task's rows, a batch at a time: a batch's counts are added, then the
    count after the ``counters`` largest is taken off all, and what is left at zero goes."""
    held: dict[bytes, int] = {}
    for batch in batches:
        for entry in pc.value_counts(batch.column("digest")).to_pylist():
            held[entry["values"]] = held.get(entry["values"], 0) + entry["counts"]
        if len(held) > counters:
            off = sorted(held.values(), reverse=True)[counters]
            held = {digest: n - off for digest, n in held.items() if n > off}
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())],
        ["digest", "n"],
    )
