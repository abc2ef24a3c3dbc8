"""City reports as the portal reads them: whole, or for the county and the cities picked."""

from __future__ import annotations

import pytest

from areaneed.plans import portal
from catalog.queries import QUERIES, warehouse


@pytest.mark.parametrize("name", ["rpt_city_time_trends", "rpt_city_time_of_day", "rpt_city_demographics"])
def test_city_report_query_returns_the_whole_report(spark, sf_dir, name):
    report = getattr(warehouse(spark, sf_dir), name)
    found = QUERIES[f"portal_{name}"](spark, sf_dir)
    assert found.count() == report.count()
    places = ["county_name", "city_name"]
    assert found.select(*places).distinct().count() == report.select(*places).distinct().count() > 8


def test_city_report_picks(spark):
    rows = [("Weld", "Greeley", 1), ("weld ", "Evans", 2), ("Adams", "greeley", 3), (None, None, 4)]
    tables = {"r": spark.createDataFrame(rows, "county_name string, city_name string, n int")}
    picked = lambda *a, **k: sorted(r["n"] for r in portal.city_report(tables, "r", *a, **k).collect())
    assert picked() == [1, 2, 3, 4]
    assert picked("WELD") == [1, 2]
    assert picked(cities=[" Greeley "]) == [1, 3]
    assert picked("weld", ["EVANS", "greeley"]) == [1, 2]
