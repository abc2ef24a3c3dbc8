"""Join shapes the jobs share. Join strategies are left to Catalyst and AQE."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaneed.functions.text import clean_key


def lookup_left(
    df: DataFrame,
    dim: DataFrame,
    left_key: str | Column,
    right_key: str,
    normalise=clean_key,
) -> DataFrame:
    """Left join on a normalised key, adding the other columns of ``dim``.

    ``dim`` holds one row per normalised key, so the row count of ``df`` stays. A key
    that is null or unknown leaves the added columns null.
    """
    left = F.col(left_key) if isinstance(left_key, str) else left_key
    added = [c for c in dim.columns if c != right_key]
    keyed = dim.select(normalise(F.col(right_key)).alias("_lookup"), *added)
    return (
        df.withColumn("_key", normalise(left))
        .join(keyed, F.col("_key") == F.col("_lookup"), "left")
        .drop("_key", "_lookup")
    )


def drill_across(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join of already aggregated frames; a null key matches a null key."""

    def merge(a: DataFrame, b: DataFrame) -> DataFrame:
        left, right = a.alias("l"), b.alias("r")
        on = reduce(
            lambda x, y: x & y, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
        )
        return left.join(right, on, "full_outer").select(
            *[F.coalesce(F.col(f"l.{k}"), F.col(f"r.{k}")).alias(k) for k in keys],
            *[F.col(f"l.{c}") for c in a.columns if c not in keys],
            *[F.col(f"r.{c}") for c in b.columns if c not in keys],
        )

    return reduce(merge, frames)


def one_row(frames: list[DataFrame]) -> DataFrame:
    """Grand totals of several frames, one row each, side by side in one row."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def anti(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose non-null key ``dim`` does not have."""
    return df.where(F.col(key).isNotNull()).join(dim.select(key), key, "left_anti")
