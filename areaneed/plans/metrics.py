"""A small metric layer: named metrics over the facts, grouped by any shared dimension.

    query_metrics(facts, dims, ["total_crimes", "avg_total_population"],
                  ["metric_time", "geo__county_name"], grain="year")
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaneed.operators.joins import drill_across, one_row


@dataclass(frozen=True)
class Metric:
    """An aggregate of one column or expression of a fact."""

    fact: str
    agg: str
    expr: str
    fill: int | None = None


@dataclass(frozen=True)
class Ratio:
    """A quotient of two metrics, which may come from different facts."""

    numerator: str
    denominator: str
    factor: float = 1.0


@dataclass(frozen=True)
class Fact:
    """Time column, and how each dimension is reached: entity -> (dim, fact key, dim key).

    ``own`` names the entity under which the fact's own columns can be grouped. ``late``
    names entities that may be many: their rows are looked up after counting by key.
    """

    time: str
    own: str
    entities: Mapping[str, tuple[str, str, str]] = field(default_factory=dict)
    late: frozenset[str] = frozenset()


FACTS = {
    "crimes": Fact(
        "incident_date",
        "incident",
        {
            "geo": ("geography", "geo_key", "geo_key"),
            "city": ("geography", "city_geo_key", "geo_key"),
            "date": ("date", "date_key", "date_key"),
            "offense": ("offense", "offense_key", "offense_key"),
            "agency": ("agency", "agency_key", "agency_key"),
        },
        frozenset({"agency"}),
    ),
    "income_population": Fact(
        "year_date", "county_year", {"geo": ("geography", "geo_key", "geo_key")}
    ),
    "business": Fact("formation_date", "business"),
    "agency_baseline": Fact("first_incident_date", "agency_baseline"),
}

METRICS: dict[str, Metric | Ratio] = {
    "total_crimes": Metric("crimes", "sum", "crime_count", fill=0),
    "crime_avg_age": Metric("crimes", "average", "age_num"),
    "avg_median_household_income": Metric(
        "income_population", "average", "median_household_income"
    ),
    "avg_per_capita_income": Metric("income_population", "average", "per_capita_income"),
    "avg_total_personal_income": Metric("income_population", "average", "total_personal_income"),
    "avg_total_population": Metric("income_population", "average", "total_population"),
    "avg_population_yoy_change": Metric("income_population", "average", "population_yoy_change"),
    "avg_population_growth_pct": Metric("income_population", "average", "population_growth_pct"),
    "counties_exceeding_10pct_growth_years": Metric(
        "income_population", "sum", "if(population_growth_pct > 10, 1, 0)"
    ),
    "business_count": Metric("business", "count", "business_key"),
    "avg_business_composite_tier": Metric("business", "average", "composite_tier"),
    "subsidy_qualifying_business_count": Metric(
        "business", "sum_boolean", "qualifies_for_subsidy"
    ),
    "notification_eligible_business_count": Metric(
        "business", "sum_boolean", "notification_eligible"
    ),
    "agency_total_crimes": Metric("agency_baseline", "sum", "total_crimes", fill=0),
    "agency_target_crimes_5pct_reduction": Metric(
        "agency_baseline", "sum", "target_crimes_5pct_reduction", fill=0
    ),
    "agency_first_incident_date": Metric("agency_baseline", "min", "first_incident_date"),
    "agency_last_incident_date": Metric("agency_baseline", "max", "last_incident_date"),
    "crime_to_population_ratio": Ratio("total_crimes", "avg_total_population"),
    "crime_rate_per_100k": Ratio("total_crimes", "avg_total_population", 100000.0),
}

# How each aggregate is counted in parts and put together again.
_PARTS = {
    "sum": lambda e: {"sum": F.sum(e)},
    "sum_boolean": lambda e: {"sum": F.count_if(e)},
    "count": lambda e: {"sum": F.count(e)},
    "average": lambda e: {"sum": F.sum(e), "rows": F.count(e)},
    "min": lambda e: {"min": F.min(e)},
    "max": lambda e: {"max": F.max(e)},
}
_MERGE = {
    "sum": lambda p: F.sum(p("sum")),
    "sum_boolean": lambda p: F.sum(p("sum")),
    "count": lambda p: F.sum(p("sum")),
    "average": lambda p: F.try_divide(F.sum(p("sum")), F.sum(p("rows"))),
    "min": lambda p: F.min(p("min")),
    "max": lambda p: F.max(p("max")),
}


def _needed(names: list[str]) -> dict[str, Metric]:
    """The simple metrics behind ``names``, ratios taken apart."""
    simple: dict[str, Metric] = {}
    for name in names:
        metric = METRICS.get(name)
        if metric is None:
            raise ValueError(f"unknown metric {name!r}")
        if isinstance(metric, Ratio):
            simple.update(_needed([metric.numerator, metric.denominator]))
        else:
            simple[name] = metric
    return simple


def _condition(column: Column, wanted) -> Column:
    if callable(wanted):
        return wanted(column)
    if isinstance(wanted, list | tuple | set):
        return column.isin(list(wanted))
    return column == wanted


def _one_fact(
    name: str,
    facts: Mapping[str, DataFrame],
    dims: Mapping[str, DataFrame],
    metrics: dict[str, Metric],
    group_by: list[str],
    grain: str,
    where: Mapping,
) -> DataFrame:
    """Look up small dimensions, count, look up large ones, and add up.

    The first count is by the requested columns and the keys of large dimensions, and
    combines in the map tasks; only counts are shuffled. Facts whose key is null or unknown
    are counted under a null, so the groups of any dimension add up to the total; a ``where``
    on a dimension leaves them out, as any comparison with a null does.
    """
    fact = FACTS[name]
    local: dict[str, Column] = {}
    early: dict[str, list[str]] = {}
    late: dict[str, list[str]] = {}
    for dimension in dict.fromkeys([*group_by, *where]):
        entity, _, column = dimension.partition("__")
        if dimension == "metric_time":
            local[dimension] = F.trunc(fact.time, grain) if grain != "day" else F.col(fact.time)
        elif entity == fact.own:
            local[dimension] = F.col(column)
        elif entity in fact.entities:
            side = late if entity in fact.late else early
            side.setdefault(entity, []).append(column)
        else:
            raise ValueError(f"{dimension!r} is not reachable from {name!r}")

    def look_up(rows: DataFrame, entity: str, columns: list[str]) -> DataFrame:
        dim, _, dim_key = fact.entities[entity]
        found = dims[dim].select(
            F.col(dim_key).alias(f"_{entity}"),
            *[F.col(c).alias(f"{entity}__{c}") for c in columns],
        )
        # A fact without a match keeps its numbers, under a null member.
        return rows.join(found, f"_{entity}", "left")

    keys = {f"_{entity}": F.col(fact.entities[entity][1]) for entity in {**early, **late}}
    rows = facts[name].withColumns({**keys, **local}) if keys or local else facts[name]
    for entity, columns in early.items():
        rows = look_up(rows, entity, columns)
    parts = [
        part.alias(f"{metric_name}.{kind}")
        for metric_name, metric in metrics.items()
        for kind, part in _PARTS[metric.agg](F.expr(metric.expr)).items()
    ]
    found = [f"{entity}__{c}" for entity, columns in early.items() for c in columns]
    rows = rows.groupBy(*local, *found, *[f"_{entity}" for entity in late]).agg(*parts)
    for entity, columns in late.items():
        rows = look_up(rows, entity, columns)
    for dimension, wanted in where.items():
        rows = rows.where(_condition(F.col(dimension), wanted))
    merged = [
        _MERGE[metric.agg](lambda kind, m=metric_name: F.col(f"`{m}.{kind}`")).alias(metric_name)
        for metric_name, metric in metrics.items()
    ]
    return rows.groupBy(*group_by).agg(*merged)


def query_metrics(
    facts: Mapping[str, DataFrame],
    dims: Mapping[str, DataFrame],
    metrics: list[str],
    group_by: list[str],
    grain: str | None = None,
    where: Mapping | None = None,
) -> DataFrame:
    """``metrics`` by ``group_by`` (``metric_time`` or ``entity__column``).

    Each fact is aggregated by itself, so joining never multiplies rows; facts then meet
    on the group columns in a full outer join, nulls with nulls. ``where`` maps a dimension to a value, a
    list of values, or a function from Column to condition.
    """
    simple = _needed(metrics)
    by_fact: dict[str, dict[str, Metric]] = {}
    for name, metric in simple.items():
        by_fact.setdefault(metric.fact, {})[name] = metric
    frames = [
        _one_fact(fact, facts, dims, wanted, group_by, grain or "day", where or {})
        for fact, wanted in by_fact.items()
    ]
    result = drill_across(frames, group_by) if group_by else one_row(frames)
    fills = {n: m.fill for n, m in simple.items() if m.fill is not None}
    result = result.fillna(fills) if fills else result
    columns = []
    for name in metrics:
        metric = METRICS[name]
        if isinstance(metric, Ratio):
            value = F.try_divide(
                F.col(metric.numerator) * F.lit(metric.factor), F.col(metric.denominator)
            )
            columns.append(value.alias(name))
        else:
            columns.append(F.col(name))
    return result.select(*group_by, *columns)


SAVED_QUERIES = {
    "county_crime_annual": (["total_crimes"], ["metric_time", "geo__county_name"], "year"),
    "subsidy_by_county": (
        ["subsidy_qualifying_business_count", "business_count"],
        ["business__principal_county"],
        None,
    ),
    "income_population_annual": (
        ["avg_median_household_income", "avg_total_population"],
        ["metric_time", "geo__county_name"],
        "year",
    ),
}


def saved_query(name: str, facts: Mapping, dims: Mapping) -> DataFrame:
    """A saved query without its display limit."""
    metrics, group_by, grain = SAVED_QUERIES[name]
    return query_metrics(facts, dims, metrics, group_by, grain)
