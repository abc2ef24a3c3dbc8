"""Physical plans that must hold at any size."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as driver
from areaneed.plans.warehouse import Warehouse
from catalog.queries import warehouse

FACT_QUERIES = [
    "rpt_city_demographics", "rpt_city_time_of_day", "rpt_city_time_trends",
    "rpt_agency_baseline", "fact_counts", "type_share_by_county",
    "categories_by_county", "county_monthly", "metrics_crimes", "metrics_crime_rate",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_no_cross_joins_and_no_python_per_row(spark, sf_dir, name):
    text = plan(driver.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text


@pytest.mark.parametrize("name", FACT_QUERIES)
def test_the_incident_fact_is_read_once_and_only_counts_are_shuffled(spark, sf_dir, name):
    lines = plan(driver.queries()[name](spark, sf_dir)).splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan" in line and "/fct_crimes-" in line]
    assert len(scans) == 1
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    above = [i for i in range(scans[0]) if depth[i] < depth[scans[0]]]
    steps = [i for i in above if all(depth[i] < depth[j] for j in range(i + 1, scans[0] + 1))]
    kinds = [k for i in reversed(steps) for k in ("Exchange", "HashAggregate") if k in lines[i]]
    assert kinds[:2] == ["HashAggregate", "Exchange"]


def scans(df) -> set[str]:
    return set(re.findall(r"FileScan .*?/([a-z_]+)-[0-9a-f]{32}", plan(df)))


@pytest.mark.parametrize("name", ["agg_county_month", "agg_city_season"])
def test_summary_tables_read_the_counts_of_one_scan(spark, sf_dir, name):
    df = driver.queries()[name](spark, sf_dir)
    assert "fact_counts" in scans(df) and "fct_crimes" not in scans(df)
    assert "Generate" not in plan(df) and "Expand" not in plan(df)


def test_tiers_and_dimensions_need_the_counts_only(spark, sf_dir):
    """Built without the raw inputs and without the incidents."""
    whole = warehouse(spark, sf_dir)
    bare = Warehouse({}, whole.run_ts)
    bare.__dict__.update(whole.tables("incident_counts", "int_income_population"))
    names = ["crime_tiers", "per_capita_tier", "final_county_tier_rank", "dim_date", "dim_offense", "dim_agency"]
    for name in names:
        assert sorted(getattr(bare, name).collect()) == sorted(getattr(whole, name).collect())


def test_all_incident_counts_take_one_scan_and_one_exchange(spark, sf_dir):
    for name, table in (("incident_counts", "int_crimes_unified"), ("fact_counts", "fct_crimes")):
        text = plan(driver.queries()[name](spark, sf_dir))
        assert len(re.findall(rf"FileScan .*?/{table}-", text)) == 1
        assert len(re.findall(r"\bExchange hashpartitioning", text)) == 1 and "Generate" not in text


def test_big_dimensions_join_by_sort_merge(spark, sf_dir):
    """With no side small enough, nothing is broadcast."""
    w = warehouse(spark, sf_dir)
    w.tables("dim_date", "dim_agency", "dim_offense", "dim_geography", "int_crimes_unified")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(driver.queries()["fct_crimes"](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in text
    assert text.count("SortMergeJoin") == 5


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    df = w.fct_crimes.where("agency_key = 3").select("incident_date")
    text = plan(df)
    assert "EqualTo(agency_key,3)" in text
    assert re.search(r"ReadSchema: struct<incident_date:date,agency_key:bigint>", text)
