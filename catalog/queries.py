"""One registered query per operator, each over the whole of its given tables.

Tables that the models share (the cleaned incidents, dimensions, facts) are written once
per session and folder, as a warehouse would hold them; the query itself always runs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaneed.constants import CRIME_CATEGORIES, VERSIONED_COLUMNS
from areaneed.functions.calendar import parse_us_date
from areaneed.functions.scores import mean_of_present
from areaneed.functions.text import (
    clean_key,
    initcap_delims,
    normalize_agency,
    normalize_county,
    normalize_county_list,
    to_whole_number,
)
from areaneed.operators import groups, joins, merge, quality
from areaneed.plans import (
    aggregates,
    checks,
    counts,
    dimensions,
    facts,
    lake,
    metrics,
    portal,
    reports,
    staging,
    tiers,
    unify,
    verified,
)
from areaneed.plans.daily import run_day
from areaneed.plans.nightly import run_to_gold
from areaneed.plans.register import Register
from areaneed.plans.search import NameIndex, build_index
from areaneed.plans.warehouse import Warehouse, layer_writer
from areaneed.sources import gate, keyed, readers, schemas, writers
from areaneed.sources.scratch import materialise, scratch_path
from areaneed.streaming.ingest import compact, current_state, stream_ingest
from catalog.inputs import DAY_1, DAY_2, RUN_TS, Landing, raw_input, raw_table

Query = Callable[[SparkSession, str], DataFrame]

SPLIT_DAY = "2024-01-16"
LATE_DAY = "2024-01-05"
EXTRACT_DAY = "2005-06-06"
AS_OF = "2024-01-20 00:00:00"

_warehouses: dict[tuple[str, str], Warehouse] = {}
_indexes: dict[int, NameIndex] = {}
_registers: dict[tuple[str, str], Register] = {}


def entity_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The register compared with its history on two days."""
    day_1 = staging.snapshot_input(raw_input(spark, sf_dir, "raw_entities_1"))
    day_2 = staging.snapshot_input(raw_input(spark, sf_dir, "raw_entities_2"))
    first = merge.scd2_snapshot(
        merge.empty_history(day_1), day_1, "entity_id", VERSIONED_COLUMNS, DAY_1
    )
    return merge.scd2_snapshot(
        materialise(first, "history"), day_2, "entity_id", VERSIONED_COLUMNS, DAY_2
    )


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The tables over ``sf_dir``, written when first used."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _warehouses:
        raw = {
            name: partial(raw_table, spark, sf_dir, f"raw_{name}")
            for name in (
                "incidents_early",
                "incidents_late",
                "income",
                "population",
                "zip_lookup",
                "centroids",
                "agency_city",
            )
        }
        raw["entities"] = partial(raw_input, spark, sf_dir, "raw_entities")
        raw["history"] = lambda: materialise(entity_history(spark, sf_dir), "history")
        # A query lands the inputs its tables need, not those of every other.
        _warehouses[key] = Warehouse(Landing(raw), RUN_TS)
    return _warehouses[key]


def plain(df: DataFrame) -> DataFrame:
    """Times as text and doubles to nine digits, so that any engine compares alike."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampNTZType | T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DoubleType | T.DecimalType):
            column = F.round(column.cast("double"), 9)
        columns.append(column.alias(field.name))
    return df.select(*columns)


QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under its own name, with comparable output."""
    QUERIES[fn.__name__] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
    return fn


def _over(name: str, fn: Callable[[Warehouse], DataFrame]) -> None:
    """Register a query over the warehouse tables."""
    QUERIES[name] = lambda spark, sf_dir: plain(fn(warehouse(spark, sf_dir)))


def _over_raw(name: str, source: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    """Register a query over one landed raw table."""
    QUERIES[name] = lambda spark, sf_dir: plain(fn(raw_table(spark, sf_dir, source)))


# Sources, sinks and ingest


@query
def read_seed(spark, sf_dir):
    seed = raw_input(spark, sf_dir, "raw_agency_city")
    path = scratch_path(spark, "seed")
    seed.write.option("nullValue", "NULL").csv(path, header=True)
    return readers.read_seed(spark, path, schemas.AGENCY_CITY_SEED)


def _land_registrations(spark, sf_dir) -> str:
    """Land every day, land one day again and land an empty batch: one copy of each."""
    rows = raw_input(spark, sf_dir, "raw_registrations")
    path = scratch_path(spark, "landed")
    writers.overwrite_partition(rows, path)
    writers.overwrite_partition(rows.where(F.col("source_date") == SPLIT_DAY), path)
    writers.overwrite_partition(rows.limit(0), path)
    return path


@query
def overwrite_partition(spark, sf_dir):
    landed = readers.read_landed(spark, _land_registrations(spark, sf_dir))
    return landed.select("source_date", "entityid", "entitystatus", "value", "event_id")


@query
def read_landed(spark, sf_dir):
    landed = readers.read_landed(spark, _land_registrations(spark, sf_dir), SPLIT_DAY)
    return landed.select("source_date", "entityid", "entitystatus", "value", "event_id")


@query
def read_landed_json(spark, sf_dir):
    path = scratch_path(spark, "pages")
    raw_input(spark, sf_dir, "raw_entities").write.json(path)
    return readers.read_landed_json(spark, path, schemas.RAW_ENTITY)


@query
def split_landed_json(spark, sf_dir):
    """Entities landed as lines of JSON, some of them cut off: accepted and rejected records."""
    raw = raw_input(spark, sf_dir, "raw_entities")
    whole = F.format_string('{"entityid":"%s","entityname":"%s"}', "entityid", "entityname")
    cut = F.col("entityid").cast("int") % 50 == 7
    lines = raw.where("entityname is not null").select(
        F.when(cut, F.substring(whole, 1, 20)).otherwise(whole).alias("value")
    )
    path = scratch_path(spark, "lines")
    lines.write.text(path)
    schema = T.StructType(schemas.RAW_ENTITY.fields[:2])
    accepted, rejected = readers.split_landed_json(spark, path, schema)
    return accepted.unionByName(
        rejected.withColumnRenamed(readers.CORRUPT, "rejected").drop("file"),
        allowMissingColumns=True,
    )


@query
def lost_values(spark, sf_dir):
    """Raw texts that staging cannot read, by column and value."""
    late = raw_table(spark, sf_dir, "raw_incidents_late")
    income = raw_table(spark, sf_dir, "raw_income")
    frames = [
        readers.lost_values(
            late,
            {
                "incident_date": parse_us_date(F.col("incident_date")),
                "incident_hour": F.col("incident_hour").try_cast("int"),
                "age_num": F.col("age_num").try_cast("int"),
            },
            ["pub_agency_name"],
        ).select("column", "value"),
        readers.lost_values(
            income, {"income": to_whole_number(F.col("income"))}, ["areaname", "periodyear"]
        ).select("column", "value"),
    ]
    return frames[0].unionByName(frames[1]).groupBy("column", "value").agg(F.count("*").alias("n"))


_over_raw(
    "filter_extract",
    "raw_entities",
    lambda raw: readers.filter_extract(raw, EXTRACT_DAY),
)
_over_raw(
    "add_audit_columns",
    "raw_entities",
    lambda raw: readers.add_audit_columns(raw, "2024-01-01", DAY_1).select(
        "entityid", "entitystatus", "_ingested_at", "_source_date"
    ),
)
_over_raw(
    "assert_rows_landed",
    "raw_registrations",
    lambda raw: writers.assert_rows_landed(raw, SPLIT_DAY)
    .groupBy("source_date", "entitystatus")
    .agg(F.count("*").alias("n")),
)
_over_raw(
    "latest_per_key",
    "raw_registrations",
    lambda raw: groups.latest_per_key(
        raw, ["source_date", "entityid"], "ingested_at", ["event_id"]
    ),
)


@query
def upsert_by_key(spark, sf_dir):
    rows = raw_input(spark, sf_dir, "raw_registrations")
    early = F.col("source_date") < F.lit(SPLIT_DAY).cast("date")
    newest = partial(
        groups.latest_per_key, keys=["entityid"], order_col="ingested_at", ties=["event_id"]
    )
    target = newest(rows.where(early)).withColumn("first_status", F.col("entitystatus"))
    return merge.upsert_by_key(target, newest(rows.where(~early)), ["entityid"])


@query
def upsert_keyed(spark, sf_dir):
    """The newest registration of each entity, in two batches, the later days first."""
    rows = raw_input(spark, sf_dir, "raw_registrations")
    late = F.col("source_date") >= F.lit(SPLIT_DAY).cast("date")
    path = scratch_path(spark, "register")
    for batch in (rows.where(late), rows.where(~late)):
        newest = groups.latest_per_key(batch, ["entityid"], "ingested_at", ["event_id"])
        keyed.upsert_keyed(newest, path, "entityid", 16, ["ingested_at", "event_id"])
    schema = keyed.with_part(newest.schema)
    return keyed.read_rows(spark, path, schema, "entityid").drop(keyed.PART)


def _daily(spark, sf_dir) -> Register:
    """Days in four runs, not in order: many days, the day after them, all later days, and an
    early day that first came without half of its rows."""
    rows = raw_input(spark, sf_dir, "raw_registrations")
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _registers:
        register = Register(
            spark,
            scratch_path(spark, "daily"),
            rows.schema,
            "entityid",
            ["ingested_at", "event_id"],
            ["entitystatus"],
        )
        day = F.col("source_date")
        split, late = (F.lit(x).cast("date") for x in (SPLIT_DAY, LATE_DAY))
        half = (day < split) & ((day != late) | (F.col("event_id") % 2 == 0))
        for part in (half, day == split, day > split, day == late):
            register.run(rows.where(part))
        _registers[key] = register
    return _registers[key]


@query
def daily_register(spark, sf_dir):
    return _daily(spark, sf_dir).current()


@query
def daily_history(spark, sf_dir):
    return _daily(spark, sf_dir).history()


@query
def scd2_snapshot(spark, sf_dir):
    return entity_history(spark, sf_dir)


@query
def scd2_as_of(spark, sf_dir):
    return merge.scd2_as_of(entity_history(spark, sf_dir), AS_OF)


@query
def scd2_at_events(spark, sf_dir):
    """Each registration with the entity's status and city at that time."""
    rows = raw_input(spark, sf_dir, "raw_registrations").select(
        "event_id", F.col("entityid").cast("bigint").alias("entity_id"), "ingested_at"
    )
    history = warehouse(spark, sf_dir).raw["history"]
    return merge.scd2_at_events(
        rows, history, "entity_id", "ingested_at", ["entity_status", "principal_city"]
    )


def _write_layer(w: Warehouse, name: str) -> DataFrame:
    table = getattr(w, name)
    return layer_writer(scratch_path(table.sparkSession, "layers"))(table, name)


_over("write_layer", lambda w: _write_layer(w, "dim_business"))
_over("write_layer_incidents", lambda w: _write_layer(w, "int_crimes_unified"))
_over("portal_reads", lambda w: portal.agency_baseline(w.tables("rpt_agency_baseline")))

for _report in ("rpt_city_time_trends", "rpt_city_time_of_day", "rpt_city_demographics"):
    _over(
        f"portal_{_report}", lambda w, name=_report: portal.city_report(w.tables(name), name)
    )

# Staging
_over_raw("stg_business_entities", "raw_entities", staging.stg_business_entities)
_over_raw("stg_crimes_1997_2015", "raw_incidents_early", staging.stg_crimes_1997_2015)
_over_raw("stg_crimes_2016_2020", "raw_incidents_late", staging.stg_crimes_2016_2020)
_over_raw("stg_income", "raw_income", staging.stg_income)
_over_raw("stg_population", "raw_population", staging.stg_population)
_over_raw("stg_city_county_zip", "raw_zip_lookup", staging.stg_city_county_zip)
_over_raw("stg_county_boundaries", "raw_centroids", staging.stg_county_boundaries)
_over("stg_snapshot", lambda w: w.stg_snapshot)

# Expressions


@query
def normalize_county_names(spark, sf_dir):
    raw = raw_input(spark, sf_dir, "raw_income")
    return raw.groupBy("areaname").agg(F.count("*").alias("n")).withColumn(
        "county", normalize_county(F.col("areaname"))
    )


def _incident_texts(spark, sf_dir, late_name: str, early_name: str) -> DataFrame:
    """Texts of all incidents, under the late period's column name."""
    late = raw_table(spark, sf_dir, "raw_incidents_late").select(late_name)
    early = raw_table(spark, sf_dir, "raw_incidents_early").select(F.col(early_name).alias(late_name))
    return late.unionByName(early).groupBy(late_name).agg(F.count("*").alias("n"))


@query
def normalize_agency_names(spark, sf_dir):
    return _incident_texts(spark, sf_dir, "pub_agency_name", "agency_name").withColumn(
        "agency", normalize_agency(F.col("pub_agency_name"))
    )


@query
def normalize_county_lists(spark, sf_dir):
    return _incident_texts(spark, sf_dir, "county_name", "primary_county").withColumn(
        "county", normalize_county_list(F.col("county_name"))
    )


@query
def initcap_delims_names(spark, sf_dir):
    return _incident_texts(spark, sf_dir, "offense_name", "offense_name").withColumn(
        "offense", initcap_delims(clean_key(F.col("offense_name")))
    )


# Join, group and score helpers


@query
def lookup_left(spark, sf_dir):
    entities = raw_input(spark, sf_dir, "raw_entities").select("entityid", "principalcity")
    zips = staging.stg_city_county_zip(raw_input(spark, sf_dir, "raw_zip_lookup"))
    cities = zips.groupBy("city").agg(
        F.min("county").alias("first_county"), F.count("*").alias("zips")
    )
    return joins.lookup_left(entities, cities, "principalcity", "city")


def _drill_across(w: Warehouse) -> DataFrame:
    yearly = w.int_crimes_unified.groupBy(
        F.col("county_name").alias("county"), F.col("incident_year").alias("year")
    ).agg(F.count("*").alias("crimes"))
    people = w.int_income_population.select(
        F.col("county_normalized").alias("county"), "year", "total_population"
    )
    return joins.drill_across([yearly, people], ["county", "year"])


_over("drill_across", _drill_across)


def _anti(w: Warehouse) -> DataFrame:
    """Areas as reported that are no single known county, such as lists of counties."""
    reported = w.int_crimes_unified.groupBy("county_name").agg(F.count("*").alias("n"))
    known = w.stg_county_boundaries.select(clean_key(F.col("county_label")).alias("county_name"))
    return joins.anti(reported, known, "county_name")


_over("anti", _anti)


def _city_category_counts(w: Warehouse) -> DataFrame:
    return w.int_crimes_unified.groupBy("city_name", "offense_category_name").agg(
        F.count("*").alias("n")
    )


def _commonest():
    return [F.desc("n"), F.asc("offense_category_name")]


_over(
    "first_of_group",
    lambda w: groups.first_of_group(_city_category_counts(w), ["city_name"], _commonest()),
)
_over(
    "top_k_per_group",
    lambda w: groups.top_k_per_group(_city_category_counts(w), ["city_name"], _commonest(), 3),
)
_over("share_of", lambda w: groups.share_of(_city_category_counts(w), "n", ["city_name"]))
_over(
    "quartile_tier",
    lambda w: groups.quartile_tier(
        w.int_crimes_unified.groupBy("county_name", "season").agg(F.count("*").alias("n")),
        "n",
        ["season"],
    ),
)
_over(
    "percent_rank_over_all",
    lambda w: groups.percent_rank(
        w.int_crimes_unified.groupBy("agency_name", "incident_date").agg(
            F.count("*").alias("n"), F.sum("age_num").alias("ages")
        ),
        "ages",
        [],
        "percentile",
    ),
)
_over(
    "pivot_max",
    lambda w: groups.pivot_max(
        w.int_crimes_unified,
        ["county_name"],
        "crime_against",
        {"Property": "property_age", "Person": "person_age", "Society": "society_age"},
        "age_num",
    ),
)
_over(
    "yoy",
    lambda w: groups.yoy(
        w.int_crimes_unified.groupBy("county_name", "incident_year").agg(
            F.count("*").alias("n")
        ),
        ["county_name"],
        ["incident_year"],
        "n",
    ),
)
_over(
    "with_key",
    lambda w: groups.with_key(
        w.int_crimes_unified.select("agency_name", "county_name", "city_name").distinct(),
        ["agency_name", "county_name", "city_name"],
        "row_key",
    ),
)


def _rebuilt_keys(w: Warehouse) -> DataFrame:
    """Agencies numbered from the early period alone, then all of them on top of these keys."""
    early = dimensions.dim_agency(w.int_crimes_unified.where("incident_year < 2003"))
    known = materialise(early, "early-agencies")
    return dimensions.dim_agency(w.int_crimes_unified, known)


_over("dim_agency_rebuilt", _rebuilt_keys)
_over(
    "mean_of_present",
    lambda w: w.final_county_tier_rank.select(
        "county",
        mean_of_present(F.col("crime_rank"), F.col("population_rank")).alias("crime_mean"),
    ),
)

# Unified tables and tiers


@query
def int_crimes_unified(spark, sf_dir):
    return unify.int_crimes_unified(
        staging.stg_crimes_1997_2015(raw_table(spark, sf_dir, "raw_incidents_early")),
        staging.stg_crimes_2016_2020(raw_table(spark, sf_dir, "raw_incidents_late")),
        raw_table(spark, sf_dir, "raw_agency_city"),
    )


@query
def int_income_population(spark, sf_dir):
    return unify.int_income_population(
        staging.stg_income(raw_table(spark, sf_dir, "raw_income")),
        staging.stg_population(raw_table(spark, sf_dir, "raw_population")),
    )


_over("incident_counts", lambda w: counts.incident_counts(w.int_crimes_unified))
_over(
    "crime_tiers",
    lambda w: tiers.crime_tiers(counts.of_set(w.incident_counts, "category")),
)
_over("crime_tier_county_rank", lambda w: tiers.crime_tier_county_rank(w.crime_tiers))
_over("income_tier", lambda w: tiers.income_tier(w.int_income_population))
_over(
    "per_capita_tier",
    lambda w: tiers.per_capita_tier(
        counts.of_set(w.incident_counts, "year"), w.int_income_population
    ),
)
_over(
    "final_county_tier_rank",
    lambda w: tiers.final_county_tier_rank(
        w.crime_tier_county_rank, w.income_tier, w.per_capita_tier
    ),
)

# Dimensions, facts, reports and summary tables
_over("dim_date", lambda w: dimensions.dim_date_spanning(w.int_crimes_unified))


def _calendar(w: Warehouse) -> DataFrame:
    """The fixed calendar with the incidents of each day, those outside it on a row of their own."""
    days = dimensions.dim_date(w.int_crimes_unified.sparkSession).select("date_day", "date_key")
    counts = w.int_crimes_unified.groupBy(F.col("incident_date").alias("date_day")).agg(
        F.count("*").alias("incidents")
    )
    inside = days.join(counts, "date_day", "left").fillna(0, ["incidents"])
    outside = joins.anti(counts, days, "date_day").agg(
        F.lit(None).cast("date").alias("date_day"),
        F.lit(None).cast("string").alias("date_key"),
        F.coalesce(F.sum("incidents"), F.lit(0)).alias("incidents"),
    )
    return inside.unionByName(outside)


_over("calendar_with_incidents", _calendar)
_over(
    "dim_geography",
    lambda w: dimensions.dim_geography(w.stg_city_county_zip, w.stg_county_boundaries),
)
_over(
    "dim_offense",
    lambda w: dimensions.dim_offense(counts.of_set(w.incident_counts, "offense")),
)
_over("dim_agency", lambda w: dimensions.dim_agency(counts.of_set(w.incident_counts, "agency")))
_over(
    "dim_business",
    lambda w: dimensions.dim_business(w.stg_snapshot, w.stg_city_county_zip, RUN_TS),
)
_over(
    "fct_crimes",
    lambda w: facts.fct_crimes(
        w.int_crimes_unified, w.dim_date, w.dim_agency, w.dim_offense, w.dim_geography
    ),
)
_over(
    "fct_income_population",
    lambda w: facts.fct_income_population(w.int_income_population, w.dim_geography),
)
_over(
    "fct_business_subsidy_tiers",
    lambda w: facts.fct_business_subsidy_tiers(
        w.dim_business, w.final_county_tier_rank, w.dim_geography
    ),
)
_over(
    "fct_business_all_versions_by_status",
    lambda w: facts.fct_business_subsidy_tiers(
        w.dim_business,
        w.final_county_tier_rank,
        w.dim_geography,
        current_only=False,
        status_rule=["Good Standing", "Exists"],
    ),
)
_over(
    "rpt_business_tier_lookup",
    lambda w: reports.rpt_business_tier_lookup(w.fct_business_subsidy_tiers),
)
_over(
    "rpt_agency_baseline", lambda w: reports.rpt_agency_baseline(w.fct_crimes, w.dim_agency)
)
_over(
    "rpt_city_demographics",
    lambda w: reports.rpt_city_demographics(w.fct_crimes, w.dim_geography, w.dim_offense),
)
_over(
    "rpt_city_time_of_day",
    lambda w: reports.rpt_city_time_of_day(w.fct_crimes, w.dim_geography, w.dim_offense),
)
_over(
    "rpt_city_time_trends",
    lambda w: reports.rpt_city_time_trends(w.fct_crimes, w.dim_geography, w.dim_date),
)
_over("fact_counts", lambda w: counts.fact_counts(w.fct_crimes, w.dim_offense))
_over(
    "agg_county_month",
    lambda w: aggregates.agg_county_month(
        w.fact_counts, w.dim_geography, w.fct_income_population
    ),
)
_over(
    "agg_tier_rankings",
    lambda w: aggregates.agg_tier_rankings(
        w.fact_counts, w.dim_geography, w.fct_income_population
    ),
)
_over(
    "agg_city_season",
    lambda w: aggregates.agg_city_season(w.fact_counts, w.dim_geography, w.dim_date),
)

# Metric layer


def _metrics(names: list[str], group_by: list[str], grain=None, where=None):
    return lambda w: metrics.query_metrics(*w.metric_inputs(), names, group_by, grain, where)


_ECONOMY = [n for n, m in metrics.METRICS.items() if getattr(m, "fact", "") == "income_population"]
_BUSINESS = [n for n, m in metrics.METRICS.items() if getattr(m, "fact", "") == "business"]
_AGENCY = [n for n, m in metrics.METRICS.items() if getattr(m, "fact", "") == "agency_baseline"]

_over(
    "metrics_crimes",
    _metrics(
        ["total_crimes", "crime_avg_age"], ["metric_time", "offense__crime_against"], "quarter"
    ),
)
_over("metrics_economy", _metrics(_ECONOMY, ["geo__county_name"]))
_over("metrics_business", _metrics(_BUSINESS, ["business__principal_county"]))
_over("metrics_agency", _metrics(_AGENCY, ["agency_baseline__county_name"]))
_over(
    "metrics_crime_rate",
    _metrics(
        ["total_crimes", "crime_to_population_ratio", "crime_rate_per_100k"],
        ["metric_time", "geo__county_name"],
        "year",
    ),
)
_over(
    "metrics_weekend_by_city",
    _metrics(
        ["total_crimes"],
        ["city__city_name", "incident__time_of_day"],
        where={"date__is_weekend": True, "offense__crime_against": ["Property", "Person"]},
    ),
)
_over(
    "metrics_by_agency",
    _metrics(
        ["total_crimes", "crime_avg_age"],
        ["agency__agency_name", "metric_time"],
        "month",
        where={"geo__county_name": lambda c: c != "nation_1"},
    ),
)
_over("metrics_totals", _metrics(["total_crimes", "crime_rate_per_100k", "business_count"], []))
for _name in metrics.SAVED_QUERIES:
    _over(
        f"saved_{_name}",
        lambda w, name=_name: metrics.saved_query(name, *w.metric_inputs()),
    )

# Portal
_PORTAL = {
    portal.sq_county_crime_annual: ["fct_crimes", "dim_geography"],
    portal.sq_subsidy_by_county: ["fct_business_subsidy_tiers"],
    portal.sq_income_population_annual: ["fct_income_population", "dim_geography"],
    portal.crime_rate_spotlight: [
        "rpt_agency_baseline",
        "fct_income_population",
        "dim_geography",
    ],
    portal.headline_stats: ["fct_crimes", "rpt_business_tier_lookup", "dim_geography"],
    portal.crime_density: ["fct_crimes", "dim_geography", "fct_income_population"],
    portal.crime_vs_income: ["fct_crimes", "dim_geography", "fct_income_population"],
    portal.categories_by_county: ["fct_crimes", "dim_geography", "dim_offense"],
    portal.type_share_by_county: ["fct_crimes", "dim_geography", "dim_offense"],
    portal.county_monthly: ["fct_crimes", "dim_geography", "dim_date"],
    portal.income_population_by_county: ["fct_income_population", "dim_geography"],
    portal.tier_breakdown: ["rpt_business_tier_lookup"],
    portal.eligible_by_county: ["rpt_business_tier_lookup"],
    portal.eligible_total: ["rpt_business_tier_lookup"],
}
# The portal shows the first rows of these.
_SHOWN = {
    "sq_county_crime_annual": 20,
    "sq_subsidy_by_county": 20,
    "sq_income_population_annual": 20,
    "crime_rate_spotlight": 15,
}


def _portal(w: Warehouse, fn, names: list[str]) -> DataFrame:
    shown = _SHOWN.get(fn.__name__)
    return fn(w.tables(*names), limit=shown) if shown else fn(w.tables(*names))


for _fn, _names in _PORTAL.items():
    _over(_fn.__name__, lambda w, fn=_fn, names=_names: _portal(w, fn, names))
_over(
    "search_businesses",
    lambda w: portal.search_businesses(w.rpt_business_tier_lookup, "customer#0000000"),
)
_over(
    "search_businesses_by_id",
    lambda w: portal.search_businesses(w.rpt_business_tier_lookup, " 123 "),
)

def _index(w: Warehouse) -> NameIndex:
    """The name index of the business lookup, written when first used."""
    lookup = w.rpt_business_tier_lookup
    if id(w) not in _indexes:
        _indexes[id(w)] = build_index(lookup, scratch_path(lookup.sparkSession, "names"), parts=16)
    return _indexes[id(w)]


_over("search_index", lambda w: _index(w).search("customer#0000000"))
_over("search_index_by_id", lambda w: _index(w).search(" 123 "))
_over("search_index_short_term", lambda w: _index(w).search("#0", max_rows=500))
_over("search_index_no_such_id", lambda w: _index(w).search("00012"))
_over(
    "name_trigrams",
    lambda w: _index(w).postings().groupBy("gram").agg(F.count("*").alias("names")),
)

_REPORT_NAMES = [
    "rpt_city_time_trends",
    "rpt_city_demographics",
    "rpt_agency_baseline",
    "rpt_business_tier_lookup",
]
for _vq, _fn in verified.VERIFIED.items():
    _over(_vq, lambda w, fn=_fn: fn(w.tables(*_REPORT_NAMES)))

# Data quality
_over(
    "dq_not_null",
    lambda w: quality.dq_not_null(
        w.fct_crimes, ["date_key", "geo_key", "city_geo_key", "offense_key", "agency_key"]
    ),
)
_over("dq_unique", lambda w: quality.dq_unique(w.dim_business, ["entity_id", "business_key"]))
_over(
    "dq_accepted_values",
    lambda w: quality.dq_accepted_values(
        w.int_crimes_unified, "offense_category_name", list(CRIME_CATEGORIES)
    ),
)
_over("dq_between", lambda w: quality.dq_between(w.int_crimes_unified, "age_num", 18, 60))
_over(
    "dq_one_current_version",
    lambda w: quality.dq_one_current_version(w.dim_business, "principal_zip", "is_current"),
)
_over(
    "dq_tier_bounds",
    lambda w: quality.dq_tier_bounds(w.fct_business_subsidy_tiers, "composite_tier", 2, 3),
)
_over(
    "dq_orphan_keys",
    lambda w: quality.dq_orphan_keys(
        w.fct_crimes.withColumn(
            "geo_key", F.expr("case when geo_key % 2 = 0 then geo_key else -geo_key end")
        ),
        w.dim_geography,
        "geo_key",
    ),
)
_over_raw(
    "dq_freshness",
    "raw_registrations",
    lambda raw: quality.dq_freshness(raw, "ingested_at", "2024-02-01 12:00:00"),
)


def _lake(w: Warehouse) -> dict[str, DataFrame]:
    """The declared lake tables."""
    raw, zips = w.raw, w.stg_city_county_zip
    entities = lake.entity_table(raw["entities"], zips)
    return {
        "raw_incidents": lake.raw_incident_table(raw["incidents_early"], raw["incidents_late"]),
        "entities": entities,
        "geocoded_entities": lake.geocoded_entity_table(entities, zips),
        "clean_incidents": lake.clean_incident_table(w.int_crimes_unified, RUN_TS),
        "clean_entities": lake.clean_entity_table(entities, RUN_TS),
    }


for _table in schemas.DECLARED:
    if _table not in ("county_month", "tier_rankings", "city_season"):
        _over(f"lake_{_table}", lambda w, name=_table: _lake(w)[name])


def _contracts(w: Warehouse) -> DataFrame:
    """Tables that keep their contracts, and the register, which is not the table declared for it."""
    results = [
        quality.dq_contract(getattr(w, name), schema, name)
        for name, schema in schemas.CONTRACTS.items()
    ]
    results.append(quality.dq_contract(w.raw["entities"], schemas.ENTITY_TABLE, "register"))
    return reduce(DataFrame.unionByName, results)


_over("dq_contract", _contracts)


def _declared(w: Warehouse) -> DataFrame:
    """All declared lake and summary tables keep to their schemas."""
    built = _lake(w) | {
        "county_month": aggregates.agg_county_month(
            w.fact_counts, w.dim_geography, w.fct_income_population
        ),
        "tier_rankings": aggregates.agg_tier_rankings(
            w.fact_counts, w.dim_geography, w.fct_income_population
        ),
        "city_season": aggregates.agg_city_season(w.fact_counts, w.dim_geography, w.dim_date),
    }
    results = [quality.dq_contract(built[n], schema, n) for n, schema in schemas.DECLARED.items()]
    return reduce(DataFrame.unionByName, results)


_over("declared_schemas", _declared)


@query
def publish_gate(spark, sf_dir):
    """Three writes of one table, the second and third with rules it breaks: what is broken, and
    the rows of the table that is still published."""
    rows, root = staging.stg_income(raw_table(spark, sf_dir, "raw_income")), scratch_path(spark, "gate")
    doubled = rows.unionByName(rows.where("income_type_code = 1"))
    tries = {
        "good": (rows, quality.not_null(["county", "year"]), []),
        "not unique": (rows, quality.not_null(["county"]), ["state_name", "county"]),
        "bad rows": (
            doubled, quality.not_null(["income"]) | quality.between("year", 1996, 2000), []
        ),
    }
    found = []
    for name, (table, rules, unique) in tries.items():
        try:
            gate.publish(table, root, "income", rows.schema, rules, unique)
        except gate.BrokenContract as error:
            found += [(name, rule, n) for rule, n in error.breaches.items()]
    report = spark.createDataFrame(found, "attempt string, rule string, failing_rows long")
    left = gate.published(spark, root, "income").count()
    return report.withColumn("published_rows", F.lit(left).cast("long"))


@query
def daily_gold(spark, sf_dir):
    """The lookup after two landed days of the register went to gold through the gate."""
    raw = {
        k: v
        for k, v in warehouse(spark, sf_dir).raw.items()
        if k not in ("entities", "history")
    }
    root = scratch_path(spark, "nightly")
    first = raw_input(spark, sf_dir, "raw_entities_1")
    day_1, day_2 = (dt.datetime.fromisoformat(x) for x in (DAY_1, DAY_2))
    run_day(spark, first, f"{root}/register", day_1.date(), day_1)
    second = raw_input(spark, sf_dir, "raw_entities_2")
    run_to_gold(spark, second, raw, root, day_2.date(), day_2)
    return gate.published(spark, f"{root}/gold", "rpt_business_tier_lookup")


def _checked_tables(w: Warehouse, names) -> dict[str, DataFrame]:
    return {n: getattr(w, n) for n in names}


_over(
    "dq_declared_row_checks",
    lambda w: checks.run_row_checks(_checked_tables(w, checks.declared_checks())),
)
_over(
    "dq_declared_unique_checks",
    lambda w: checks.run_unique_checks(_checked_tables(w, checks.UNIQUE_COLUMNS)),
)
_over(
    "dq_invariants",
    lambda w: checks.run_invariants(
        w.tables("dim_business", "fct_business_subsidy_tiers", "fct_crimes", "dim_geography")
    ),
)

# Streaming


@query
def stream_ingest_state(spark, sf_dir):
    """Days arrive as files, are taken in twice (before and after a compaction)."""
    landed = scratch_path(spark, "arrivals")
    target = scratch_path(spark, "stream")
    rows = raw_input(spark, sf_dir, "raw_registrations")
    early = F.col("source_date") < F.lit(SPLIT_DAY).cast("date")
    take = partial(
        stream_ingest,
        spark,
        landed,
        rows.schema,
        target,
        f"{target}/checkpoint",
        ["entityid"],
        "ingested_at",
        ["event_id"],
    )
    rows.where(early).write.mode("append").parquet(landed)
    take()
    compact(spark, target, ["entityid"], "ingested_at", ["event_id"])
    rows.where(~early).write.mode("append").parquet(landed)
    take()
    return current_state(spark, target, ["entityid"], "ingested_at", ["event_id"])
