"""Data-quality checks. Each returns rows of (check, failing_rows); 0 is a pass."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaneed.operators.joins import anti


def dq_rows(df: DataFrame, failing: Mapping[str, Column]) -> DataFrame:
    """Count the rows that fail each condition, all conditions in one pass."""
    counts = df.agg(*[F.count_if(cond).alias(f"c{i}") for i, cond in enumerate(failing.values())])
    results = [
        F.struct(F.lit(name).alias("check"), F.col(f"c{i}").alias("failing_rows"))
        for i, name in enumerate(failing)
    ]
    return counts.select(F.explode(F.array(*results)).alias("r")).select("r.*")


def not_null(cols: Iterable[str]) -> dict[str, Column]:
    return {f"not_null {c}": F.col(c).isNull() for c in cols}


def accepted_values(col: str, values: Iterable) -> dict[str, Column]:
    return {f"accepted_values {col}": ~F.col(col).isin(list(values))}


def between(col: str, lo=None, hi=None) -> dict[str, Column]:
    value = F.col(col)
    tests = ([value < lo] if lo is not None else []) + ([value > hi] if hi is not None else [])
    return {f"between {col}": reduce(lambda a, b: a | b, tests, F.lit(False))}


def dq_not_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Rows with a null, per column."""
    return dq_rows(df, not_null(cols))


def dq_unique(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Distinct non-null values that occur more than once, per column.

    One exchange for all columns: each value goes on as (column, value as text), counted in the map
    tasks already, so a value that many rows have is one row a task.
    """
    cols = list(cols)
    values = [
        F.struct(F.lit(i).alias("col"), F.col(f"`{c}`").cast("string").alias("value"))
        for i, c in enumerate(cols)
    ]
    counted = (
        df.select(F.explode(F.array(*values)).alias("v"))
        .where("v.value is not null")
        .groupBy("v.col", "v.value")
        .agg(F.count("*").alias("n"))
    )
    twice = F.col("n") > 1
    return dq_rows(
        counted, {f"unique {c}": (F.col("col") == i) & twice for i, c in enumerate(cols)}
    )


def dq_accepted_values(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """Rows with a value outside the list; null passes."""
    return dq_rows(df, accepted_values(col, values))


def dq_between(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """Rows outside [lo, hi]; either end may be open, null passes."""
    return dq_rows(df, between(col, lo, hi))


def dq_one_current_version(df: DataFrame, key: str, flag: str) -> DataFrame:
    """Keys with more than one current row (a key without any is not seen)."""
    per_key = df.where(F.col(flag)).groupBy(key).agg(F.count("*").alias("n"))
    return dq_rows(per_key, {f"one_current_version {key}": F.col("n") != 1})


def dq_tier_bounds(df: DataFrame, col: str, lo: int = 1, hi: int = 4) -> DataFrame:
    """Rows with a tier outside its range."""
    return dq_rows(df, {f"tier_bounds {col}": ~F.col(col).between(lo, hi)})


def dq_orphan_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct fact keys the dimension lacks. Keys are made distinct before the join."""
    missing = anti(fact.select(key).distinct(), dim, key)
    return dq_rows(missing, {f"orphan_keys {key}": F.lit(True)})


def dq_freshness(
    df: DataFrame,
    col: str,
    now: dt.datetime | str,
    warn_hours: float = 24,
    error_hours: float = 48,
) -> DataFrame:
    """Age of the newest row at ``now``: pass, warn or error; an empty table is an error."""
    newest = df.agg(F.max(F.col(col).cast("timestamp_ntz")).alias("newest"))
    age = F.timestamp_diff("SECOND", F.col("newest"), F.lit(str(now)).cast("timestamp_ntz")) / 3600
    status = (
        F.when(F.col("newest").isNull() | (F.col("age_hours") > error_hours), "error")
        .when(F.col("age_hours") > warn_hours, "warn")
        .otherwise("pass")
    )
    return (
        newest.withColumn("age_hours", F.round(age, 4))
        .withColumn("status", status)
        .select(
            F.lit(f"freshness {col}").alias("check"),
            (F.col("status") == "error").cast("bigint").alias("failing_rows"),
            "status",
            "age_hours",
        )
    )


def contract_breaches(df: DataFrame, schema: T.StructType) -> list[str]:
    """Columns that are missing, undeclared or of another type; order does not matter."""
    have = {f.name.lower(): f.dataType for f in df.schema}
    want = {f.name.lower(): f.dataType for f in schema}
    return sorted(c for c in have.keys() | want.keys() if have.get(c) != want.get(c))


def dq_contract(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """Columns in breach of the declared schema, and how many rows the table has."""
    breaches = len(contract_breaches(df, schema))
    return df.agg(F.count("*").alias("checked_rows")).select(
        F.lit(f"contract {name}").alias("check"),
        F.lit(breaches).cast("bigint").alias("failing_rows"),
        "checked_rows",
    )
