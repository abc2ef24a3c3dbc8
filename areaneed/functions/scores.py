"""Tier arithmetic as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from areaneed.constants import TIER_LABELS, TIER_STEPS, UNRANKED_LABEL


def quartile(percentile: Column, inverse: bool = False) -> Column:
    """Tier 1-4 of a percentile; ``inverse`` gives the low end tier 4."""
    tier = F.lit(1)
    for start, step in reversed(TIER_STEPS):
        tier = F.when(percentile >= start, F.lit(step)).otherwise(tier)
    return F.lit(5) - tier if inverse else tier


def mean_of_present(*ranks: Column) -> Column:
    """Mean of the ranks above zero, rounded half up; null when there is none."""
    total = reduce(lambda a, b: a + b, ranks)
    present = reduce(lambda a, b: a + b, [(r > 0).cast("int") for r in ranks])
    return F.round(F.try_divide(total, present)).cast("int")


def tier_label(tier: Column) -> Column:
    label = F.lit(UNRANKED_LABEL)
    for value, text in TIER_LABELS.items():
        label = F.when(tier == value, text).otherwise(label)
    return label


def rate(numerator: Column, denominator: Column, per: float, digits: int) -> Column:
    """numerator * per / denominator, rounded; null when the denominator is 0 or null."""
    return F.round(F.try_divide(numerator * F.lit(float(per)), denominator), digits)
