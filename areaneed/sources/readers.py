"""Readers for seed files, landed days and landed JSON pages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaneed.constants import HOME_STATE_CODE
from areaneed.functions.text import null_tokens_to_null
from areaneed.sources.scratch import materialise


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line; missing-value markers become null, then types apply.

    Everything is read as text first, so a marker in a numeric column is a null
    and not a parse failure. A byte-order mark and CRLF line ends are fine.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = spark.read.schema(text).csv(path, header=True, enforceSchema=True)
    return raw.select(
        *[null_tokens_to_null(F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema]
    )


def read_landed(
    spark: SparkSession,
    root: str,
    source_date: dt.date | str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Landed Parquet, columns matched by name; one day reads only its folder.

    With a ``schema`` no file has to be opened to learn the columns; without one the
    columns of all files are merged.
    """
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)
    landed = reader.parquet(root)
    if source_date is None:
        return landed
    return landed.where(F.col("source_date") == F.lit(str(source_date)).cast("date"))


def read_landed_json(
    spark: SparkSession, glob: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """All landed pages as one batch of text columns; an empty page adds nothing.

    A line holds one record or a whole page (an array of records). ``multi_line`` reads
    pages that are printed over many lines, one page per file.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    return spark.read.schema(text).option("multiLine", multi_line).json(glob)


#: Holds the text of a record that is no JSON object, or not of text fields.
CORRUPT = "_corrupt"


def split_landed_json(
    spark: SparkSession, glob: str, schema: T.StructType, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected records of landed pages: together they are all that landed.

    As ``read_landed_json``, but a record that cannot be read is kept: a rejected row has its text
    and its file. A line that holds a page stands or falls as a whole. The pages are parsed once,
    into a written table that both results read.
    """
    fields = [T.StructField(f.name, T.StringType()) for f in schema]
    text = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    pages = spark.read.schema(text).option("multiLine", multi_line)
    pages = pages.option("columnNameOfCorruptRecord", CORRUPT).json(glob)
    read = materialise(pages.select("*", F.col("_metadata.file_name").alias("file")), "parsed")
    accepted = read.where(F.col(CORRUPT).isNull()).select(*[f.name for f in fields])
    return accepted, read.where(F.col(CORRUPT).isNotNull()).select("file", CORRUPT)


def lost_values(
    raw: DataFrame, staged: dict[str, Column], key: list[str], blank: list[str] | None = None
) -> DataFrame:
    """Values that staging would turn into null: (``key``, column, value) rows.

    ``staged`` maps a raw column to its staged expression. A value is lost where the raw text is
    there and the expression gives null; texts in ``blank`` mean a missing value and are not lost.
    """
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"`{c}`").cast("string").alias("value"),
            expr.isNull().alias("gone"),
        )
        for c, expr in staged.items()
    ]
    rows = raw.select(*key, F.explode(F.array(*cells)).alias("cell")).select(*key, "cell.*")
    lost = rows.where(F.col("gone") & F.col("value").isNotNull())
    if blank:
        lost = lost.where(~F.col("value").isin(blank))
    return lost.drop("gone")


def filter_extract(
    df: DataFrame,
    date: dt.date | str,
    date_col: str = "entityformdate",
    state_col: str = "principalstate",
    state: str = HOME_STATE_CODE,
    key: str = "entityid",
) -> DataFrame:
    """Records formed on ``date`` in the home state. Each task's rows are in key order; the whole
    extract is not sorted, since it is landed by day and read by key."""
    return df.where(
        (F.col(date_col).cast("date") == F.lit(str(date)).cast("date"))
        & (F.col(state_col) == state)
    ).sortWithinPartitions(key)


def add_audit_columns(
    df: DataFrame, source_date: dt.date | str, ingested_at: dt.datetime | str
) -> DataFrame:
    """One load time and one source date for the whole batch, both passed in."""
    return df.withColumns(
        {
            "_ingested_at": F.lit(str(ingested_at)).cast("timestamp_ntz"),
            "_source_date": F.lit(str(source_date)).cast("date"),
        }
    )
