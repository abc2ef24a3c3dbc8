"""Landing, layer tables and the landed-rows gate."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaneed.sources.gate import publish


class NoRowsLanded(RuntimeError):
    """Raised when a day that should have landed has no rows."""


def overwrite_partition(
    df: DataFrame, path: str, partition: str = "source_date", rows_per_file: int = 5_000_000
) -> bool:
    """Replace exactly the days present in ``df``; an empty batch changes nothing.

    Landing the same day twice leaves one copy. Rows stay in the tasks that hold
    them, so a day with most of the rows is still written by many tasks.
    Returns whether anything was written.
    """
    if df.isEmpty():
        return False
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(partition)
        .parquet(path)
    )
    return True


def assert_rows_landed(
    df: DataFrame, source_date: dt.date | str, date_col: str = "source_date"
) -> DataFrame:
    """The day's rows, or ``NoRowsLanded``; the check stops at the first row."""
    day = df.where(F.col(date_col) == F.lit(str(source_date)).cast("date"))
    if day.isEmpty():
        raise NoRowsLanded(f"no rows landed for {source_date}")
    return day


def write_layer(
    df: DataFrame,
    name: str,
    layer: str,
    root: str | None = None,
    sort: list[str] | None = None,
    partition: list[str] | None = None,
) -> DataFrame:
    """Raw models become views; silver and gold models become Parquet tables.

    ``sort`` clusters the table: a range split by the key, then a sort in each file for
    min/max skipping. The split also uses a row number, so that rows with one key, or
    plain copies of one row, are spread over several tasks and files. Rows are
    ordered before they are numbered, so a repeated task numbers them the same.
    ``partition`` writes one folder per value. Each write has a folder of its own and is published at
    its end, so a table can be rebuilt from itself, open readers of the last one go on, and two
    writers do not disturb each other: the one that ends last is read.
    """
    if layer == "raw":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if root is None:
        raise ValueError("silver and gold tables need a root folder")
    out = df
    if sort:
        keys = [_sort_key(s) for s in sort]
        out = (
            df.sortWithinPartitions(*df.columns)
            .withColumn("_spread", F.monotonically_increasing_id())
            .repartitionByRange(*keys, "_spread")
            .sortWithinPartitions(*keys)
            .drop("_spread")
        )
    return publish(out, f"{root}/{layer}", name, partition=partition or ())


def _sort_key(spec: str):
    """'x' sorts upwards, '-x' downwards."""
    return F.col(spec[1:]).desc() if spec.startswith("-") else F.col(spec).asc()
