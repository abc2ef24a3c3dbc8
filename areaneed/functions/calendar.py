"""Date and hour labels as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from areaneed.constants import DAY_HOURS, MONTHS, WEEKDAYS


def parse_us_date(col: Column) -> Column:
    """MM/dd/yyyy text to a date, null when it does not parse."""
    return F.try_to_date(col, "MM/dd/yyyy")


def season(day: Column) -> Column:
    """Meteorological season: December to February is winter, and so on."""
    quarter_from_december = F.floor(F.month(day) % 12 / 3)
    return F.element_at(
        F.array(*[F.lit(s) for s in ("winter", "spring", "summer", "fall")]),
        (quarter_from_december + 1).cast("int"),
    )


def time_of_day(hour: Column) -> Column:
    """'day' inside the day hours; anything else, a missing hour too, is 'night'."""
    return F.when(hour.between(*DAY_HOURS), "day").otherwise("night")


def month_name(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(day))


def day_name(day: Column) -> Column:
    """Name of the week day; Spark counts from 1 = Sunday."""
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.dayofweek(day))


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)
