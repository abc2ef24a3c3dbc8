"""Tables laid out by a hash of their key: a change rewrites only the parts its keys fall in.

A part is one folder. Parts are replaced by Spark's dynamic partition overwrite, from rows that are
written elsewhere first, so a job never reads what it overwrites. A folder that loses all its rows is
replaced by one row without a key, which readers leave out.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaneed.sources.scratch import materialise

PART = "key_part"


def key_part(key: str | Column, parts: int) -> Column:
    """The part of a key; keys of any type are taken as text."""
    column = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(column.cast("string")), F.lit(parts)).cast("int")


def read_rows(
    spark: SparkSession, path: str, schema: T.StructType, key: str
) -> DataFrame:
    """All rows of a table, none where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path).where(F.col(key).isNotNull())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def replace_folders(rows: DataFrame, path: str, column: str, key: str, folders: list) -> None:
    """Replace the named folders (values of ``column``) by ``rows``, which lie in them."""
    if not folders:
        return
    spark = rows.sparkSession
    kind = rows.schema[column].dataType.simpleString()
    empty = spark.createDataFrame([(x,) for x in folders], f"{column} {kind}")
    staged = materialise(rows.unionByName(empty, allowMissingColumns=True), "folders")
    (
        staged.repartition(column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def with_part(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(PART, T.IntegerType())])


def replace_keys(
    rows: DataFrame, keys: DataFrame, path: str, key: str, parts: int
) -> list[int]:
    """In the table at ``path`` the rows of all ``keys`` give way to ``rows``; a key that
    ``rows`` lacks goes. Returns the parts rewritten, of which there are ``parts`` at most."""
    keys = keys.select(key).distinct().withColumn(PART, key_part(key, parts))
    touched = sorted(r[0] for r in keys.select(PART).distinct().collect())
    old = read_rows(rows.sparkSession, path, with_part(rows.schema), key)
    old = old.where(F.col(PART).isin(touched)).join(keys.select(key), key, "left_anti")
    new = rows.withColumn(PART, key_part(key, parts))
    replace_folders(old.unionByName(new), path, PART, key, touched)
    return touched


def upsert_keyed(
    batch: DataFrame, path: str, key: str, parts: int, newer_by: list[str] | None = None
) -> list[int]:
    """Rows of ``batch`` (one per key) replace those of their keys, nulls too, and new keys are added.

    With ``newer_by`` a row is only replaced when it does not come later than the batch's, by these
    columns in turn, nulls first; so batches may come in any order and any number of times. Rows with
    a null key are left out. Only the parts that hold a key of the batch are read and written;
    the others keep their files. Returns the parts rewritten.
    """
    spark = batch.sparkSession
    batch = batch.dropna(subset=[key]).withColumn(PART, key_part(key, parts))
    batch = materialise(batch, "batch")
    touched = sorted(r[0] for r in batch.select(PART).distinct().collect())
    old = read_rows(spark, path, batch.schema, key).where(F.col(PART).isin(touched))
    columns = [c for c in batch.columns if c not in (key, PART)]
    pairs = old.select(PART, key, F.struct(*columns).alias("old")).join(
        batch.select(PART, key, F.struct(*columns).alias("new")), [PART, key], "full_outer"
    )
    take = F.col("new").isNotNull()
    if newer_by:
        order = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in newer_by])
        take = take & (F.col("old").isNull() | (order("new") >= order("old")))
    merged = pairs.withColumn("row", F.when(take, F.col("new")).otherwise(F.col("old")))
    merged = merged.select(PART, key, "row.*").select(*batch.columns)
    replace_folders(merged, path, PART, key, touched)
    return touched
