"""What a query lands, how the incidents are joined, and agency names cleaned behind a guard."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from areaneed.constants import AGENCY_REWRITES
from areaneed.functions import text
from catalog import inputs
from catalog.queries import QUERIES


def test_a_query_lands_only_the_inputs_its_tables_need(spark, sf_dir, tmp_path):
    for table in inputs.TABLES:
        os.symlink(f"{sf_dir}/{table}.parquet", tmp_path / f"{table}.parquet")
    assert QUERIES["yoy"](spark, str(tmp_path)).count() > 0
    landed = {name for _, at, name in inputs._landed if at == str(tmp_path)}
    assert landed == {"raw_incidents_early", "raw_incidents_late", "raw_agency_city"}


def test_an_input_is_made_once():
    made = []
    landing = inputs.Landing({"a": lambda: made.append("a") or 1, "b": lambda: made.append("b") or 2})
    assert (landing["a"], landing["a"], made, list(landing)) == (1, 1, ["a"], ["a", "b"])
    assert dict(landing.items()) == {"a": 1, "b": 2}


def test_customers_are_looked_up_for_orders_not_for_lines(spark, sf_dir):
    for name in ("raw_incidents_early", "raw_incidents_late"):
        df = inputs.raw_input(spark, sf_dir, name)
        lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
        (at,) = [i for i, x in enumerate(lines) if "Join Inner" in x and "o_custkey" in x]
        end = next((i for i in range(at + 1, len(lines)) if depth[i] <= depth[at]), len(lines))
        assert not any("l_orderkey" in line for line in lines[at + 1 : end])


def test_guarded_agency_patterns_give_what_the_patterns_give(spark):
    ends = ["", " Police Department", " POLICE  department", " police department's", " Sheriff", " County Sheriff's Office",
            " sheriffs", "\tSheriff's office", " Drug Enforcement Team", " drug enforcement teams", " Sher Police Departmentiff"]
    names = [a + b + c for a in ["", "Weld", "  Ünal İ"] for b in ends for c in ends]
    df = spark.createDataFrame([(n,) for n in [*names, None]], "n string")
    rules = [("(?i)" + pattern, new) for pattern, new in AGENCY_REWRITES]
    plain = F.trim(text.rewrite(F.col("n"), rules))
    wrong = df.where(~text.normalize_agency(F.col("n")).eqNullSafe(plain))
    assert wrong.collect() == []
