"""Time the headline queries and print one JSON line.

``build_*`` entries start from the given tables (or the written tables below) and write
their result, once. The other entries read the written warehouse, as a report does:
one warm-up, then the median of three runs. Every result is fully computed (noop sink).
``setup_sec`` is the time to derive and land the raw inputs; it is not in the total.
With ``BENCH_ALL`` set every query over the warehouse is timed, not the headline ones alone.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from catalog.queries import QUERIES, warehouse  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

BUILDS = [
    "int_crimes_unified", "int_income_population", "dim_date", "dim_geography", "dim_offense",
    "dim_agency", "dim_business", "fct_crimes", "final_county_tier_rank",
    "fct_business_subsidy_tiers", "fct_income_population", "rpt_agency_baseline",
    "rpt_business_tier_lookup",
]
HEADLINE = [
    "int_crimes_unified", "int_income_population", "latest_per_key", "upsert_by_key",
    "scd2_snapshot",
    "crime_tiers", "income_tier", "per_capita_tier", "final_county_tier_rank",
    "dim_business", "dim_agency", "dim_offense", "fct_crimes", "fct_income_population",
    "fct_business_subsidy_tiers", "rpt_agency_baseline", "rpt_city_demographics",
    "rpt_city_time_of_day", "rpt_city_time_trends", "agg_county_month", "agg_city_season",
    "metrics_crimes", "metrics_crime_rate", "crime_density", "type_share_by_county",
    "crime_rate_spotlight", "headline_stats", "search_businesses", "dq_not_null", "dq_invariants",
]


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    start = time.perf_counter()
    tables = warehouse(spark, SF_DIR)
    setup = time.perf_counter() - start
    for name in BUILDS:
        times[f"build_{name}"] = seconds(lambda name=name: getattr(tables, name))

    for name in sorted(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE:

        def run(name=name):
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

        run()
        times[name] = statistics.median(seconds(run) for _ in range(RUNS))

    print(
        json.dumps(
            {
                "metric": "total seconds: warehouse build once, headline queries warm",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in times.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "setup_sec": round(setup, 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
