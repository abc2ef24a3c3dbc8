"""Column expressions on hand-made values."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from areaneed.functions import calendar, scores, text


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("Denver County, CO", "denver"),
        ("Denver County, Colorado ", "denver"),
        ("  El   Paso County", "el paso"),
        ("County Line County", "county line"),
        ("Park", "park"),
        (None, None),
    ],
)
def test_normalize_county(spark, raw, clean):
    assert apply(spark, text.normalize_county, [raw]) == [clean]


def test_normalize_agency(spark):
    raw = [
        "Aurora Police Department",
        "Weld County Sheriff's Office",
        "Park Sheriff",
        "metro DRUG ENFORCEMENT TEAM",
        "Sheriffson",
        None,
    ]
    expected = ["Aurora", "Weld", "Park", "metro Drug Task Force", "Sheriffson", None]
    assert apply(spark, text.normalize_agency, raw) == expected


def test_normalize_county_list(spark):
    raw = ["Weld; Adams", "Weld,Adams ; Boulder", " Weld ", "El Paso", None]
    expected = ["adams, weld", "adams, boulder, weld", "weld", "el paso", None]
    assert apply(spark, text.normalize_county_list, raw) == expected


def test_initcap_starts_words_after_delimiters(spark):
    raw = ["larceny/theft offenses", "burglary/breaking & entering", "a-b_c.d(e)[f]", "", None]
    expected = ["Larceny/Theft Offenses", "Burglary/Breaking & Entering", "A-B_C.D(E)[F]", "", None]
    assert apply(spark, text.initcap_delims, raw) == expected


def test_clean_zip_matches_the_whole_text(spark):
    raw = ["80202", "80202-1234", "80202\n", "8020", "802021", "80202-12", " 80202", None]
    assert apply(spark, text.clean_zip, raw) == ["80202", "80202"] + [None] * 6


def test_to_whole_number(spark):
    raw = ["1,234,567", "12", "N/A", "", "3000000000", None]
    assert apply(spark, text.to_whole_number, raw) == [1234567, 12, None, None, 3000000000, None]


def test_dates(spark):
    raw = ["02/29/2020", "02/30/2020", "2020-01-01", "unknown", None]
    assert apply(spark, calendar.parse_us_date, raw) == [dt.date(2020, 2, 29)] + [None] * 4


def test_season_and_names(spark):
    days = [dt.date(2020, m, 1) for m in range(1, 13)]
    expected = ["winter"] * 2 + ["spring"] * 3 + ["summer"] * 3 + ["fall"] * 3 + ["winter"]
    assert apply(spark, calendar.season, days, "date") == expected
    sunday = dt.date(2024, 6, 2)
    assert apply(spark, calendar.day_name, [sunday], "date") == ["Sunday"]
    assert apply(spark, calendar.is_weekend, [sunday], "date") == [True]
    assert apply(spark, calendar.month_name, [sunday], "date") == ["June"]


def test_time_of_day(spark):
    hours = [5, 6, 17, 18, None]
    expected = ["night", "day", "day", "night", "night"]
    assert apply(spark, calendar.time_of_day, hours, "int") == expected


def test_quartile_edges(spark):
    values = [0.0, 0.2499, 0.25, 0.5, 0.75, 1.0]
    assert apply(spark, scores.quartile, values, "double") == [1, 1, 2, 3, 4, 4]
    inverse = apply(spark, lambda c: scores.quartile(c, inverse=True), values, "double")
    assert inverse == [4, 4, 3, 2, 1, 1]


def test_mean_of_present(spark):
    rows = [(4, 3, 0), (2, 0, 0), (0, 0, 0), (4, 4, 3), (1, 2, 2)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    mean = scores.mean_of_present(F.col("a"), F.col("b"), F.col("c"))
    assert [r[0] for r in df.select(mean).collect()] == [4, 2, None, 4, 2]
