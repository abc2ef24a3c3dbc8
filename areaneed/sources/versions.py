"""Whole-table versions: write a new folder, let readers take the newest complete one.

A job can then read a table and write its next state without touching what it reads,
and a failed or repeated write is never seen half done: Spark adds ``_SUCCESS`` last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def committed(
    spark: SparkSession, root: str, name: str = "version", after: int = -1
) -> list[int]:
    """Numbers above ``after`` of the complete ``name=<n>`` folders under ``root``, ascending."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    folder = path_of(root)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    found = []
    for status in fs.listStatus(folder):
        key, _, number = status.getPath().getName().partition("=")
        if key != name or int(number) <= after:
            continue
        if fs.exists(path_of(status.getPath(), "_SUCCESS")):
            found.append(int(number))
    return sorted(found)


def write_version(df: DataFrame, root: str, number: int) -> DataFrame:
    """Write version ``number``; writing it again replaces it."""
    path = f"{root}/version={number}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_version(spark: SparkSession, root: str, number: int | None = None) -> DataFrame | None:
    """A version, by default the newest complete one; None when there is none."""
    if number is None:
        numbers = committed(spark, root)
        if not numbers:
            return None
        number = numbers[-1]
    return spark.read.parquet(f"{root}/version={number}")
