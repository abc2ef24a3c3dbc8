"""Per-group picks, shares, tiers and keys."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areaneed.functions.scores import quartile
from areaneed.sources.scratch import materialise


def top_k_per_group(
    df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rnk"
) -> DataFrame:
    """The first ``k`` rows of each group in ``order``, with their rank.

    Spark cuts each group to ``k`` rows inside every map task before it shuffles
    (WindowGroupLimit), so a group with most of the rows stays cheap.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def first_of_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in ``order``."""
    return top_k_per_group(df, keys, order, 1, "_rank").drop("_rank")


def latest_per_key(
    df: DataFrame, keys: list[str], order_col: str, ties: list[str] | None = None
) -> DataFrame:
    """The newest row of each key; rows with a null key are skipped.

    ``ties`` names the columns that decide, highest first, between rows of the same time.
    """
    order = [F.col(c).desc_nulls_last() for c in [order_col, *(ties or [])]]
    return first_of_group(df.dropna(subset=keys), keys, order)


def count_sets(df: DataFrame, sets: Mapping[str, list[str]], *more: Column) -> DataFrame:
    """Rows (``n``) and ``more`` aggregates by each of several sets of columns, in one scan.

    ``set`` names the set a row belongs to; the columns of other sets are null there. A null in a
    column of the set's own is a value like any other. Only counts are shuffled.
    """
    columns = list(dict.fromkeys(c for keys in sets.values() for c in keys))
    # The bits of the grouping id, first column first, mark the columns a set is without.
    ids = {
        name: sum((c not in keys) << i for i, c in enumerate(reversed(columns)))
        for name, keys in sets.items()
    }
    if len(set(ids.values())) < len(ids):
        raise ValueError("two sets have the same columns")
    name = F.lit(None).cast("string")
    for label, id_ in ids.items():
        name = F.when(F.grouping_id() == id_, label).otherwise(name)
    groups = [[F.col(c) for c in keys] for keys in sets.values()]
    return df.groupingSets(groups, *[F.col(c) for c in columns]).agg(
        name.alias("set"), F.count("*").alias("n"), *more
    )


def how_many(df: DataFrame) -> Column:
    """Rows of a group, where ``df`` holds plain rows or counts of them in ``n``."""
    return F.sum("n") if "n" in df.columns else F.count("*")


def share_of(
    df: DataFrame, measure: str, keys: list[str], name: str = "share_pct", digits: int = 2
) -> DataFrame:
    """Percentage of the group total. ``df`` is already aggregated: a group is a few rows.

    One pass: totals by a second aggregation and a join would read the fact twice.
    """
    total = F.sum(measure).over(Window.partitionBy(*keys))
    share = F.try_divide(F.col(measure) * F.lit(100.0), total)
    return df.withColumn(name, F.round(share, digits))


def quartile_tier(
    df: DataFrame,
    measure: str,
    partition: list[str] | None = None,
    inverse: bool = False,
    percentile: str = "percentile",
    tier: str = "tier",
) -> DataFrame:
    """Percentile rank of ``measure`` and its tier 1-4, in each group of ``partition`` or over all rows."""
    ranked = percent_rank(df, measure, partition or [], percentile)
    return ranked.withColumn(tier, quartile(F.col(percentile), inverse))


def percent_rank(df: DataFrame, measure: str, partition: list[str], name: str) -> DataFrame:
    """``(rank - 1) / (rows - 1)`` of ``measure`` in its group, 0 in a group of one row; nulls first.

    Not a window over the group, which would be one task: equal values are counted together, the
    different values are sorted by range over all tasks, and to the counts before a value in its
    range are added those of the group's earlier ranges. Ties share one counted row, so they cannot
    be parted by a border. ``df`` is read twice, so it is written first.
    """
    df = materialise(df, "ranked")
    # Without a partition all rows are one group under a constant.
    keys = [F.col(f"`{c}`") for c in partition] or [F.lit(0)]
    keys = [key.alias(f"_g{i}") for i, key in enumerate(keys)]
    group = [f"_g{i}" for i in range(len(keys))]
    values = df.groupBy(*keys, F.col(f"`{measure}`").alias("_value")).agg(F.count("*").alias("_n"))
    ranges = values.repartitionByRange(*group, "_value").withColumn("_range", F.spark_partition_id())
    ranges = materialise(ranges, "ranked-values")
    # An entry a group and range it lies in; a group has one row here.
    sizes = ranges.groupBy(*group, "_range").agg(F.sum("_n").alias("n"))
    listed = F.sort_array(F.collect_list(F.struct("_range", "n")))
    sizes = sizes.groupBy(*group).agg(listed.alias("_ranges"))
    earlier = F.aggregate(
        F.filter("_ranges", lambda x: x["_range"] < F.col("_range")),
        F.lit(0).cast("long"),
        lambda total, x: total + x["n"],
    )
    rows = F.aggregate("_ranges", F.lit(0).cast("long"), lambda total, x: total + x["n"])
    here = Window.partitionBy("_range", *group).orderBy("_value").rowsBetween(
        Window.unboundedPreceding, -1
    )
    within = F.coalesce(F.sum("_n").over(here), F.lit(0))
    ranked = _null_safe(ranges.withColumn("_within", within), sizes, group).select(
        *group, "_value", "_within", "_range", "_ranges"
    )
    before = (F.col("_within") + earlier).cast("double")
    share = F.when(rows > 1, before / (rows - 1)).otherwise(F.lit(0.0))
    ranked = ranked.select(*group, "_value", share.alias("_share"))
    columns = [c for c in df.columns if c != name]
    named = df.select("*", *keys, F.col(f"`{measure}`").alias("_value"))
    out = _null_safe(named, ranked, [*group, "_value"])
    return out.select(*[F.col(f"`{c}`") for c in columns], F.col("_share").alias(name))


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of rows that all have a partner, nulls with nulls."""
    renamed = right.withColumnsRenamed({c: f"{c}_r" for c in keys})
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{c}_r")) for c in keys])
    return left.join(renamed, on).drop(*[f"{c}_r" for c in keys])


def pivot_max(
    df: DataFrame, keys: list[str], column: str, values: Mapping, measure: str, *extra: Column
) -> DataFrame:
    """One column per entry of ``values`` (value -> name), holding the group's maximum."""
    picks = [
        F.max(F.when(F.col(column) == value, F.col(measure))).alias(name)
        for value, name in values.items()
    ]
    return df.groupBy(*keys).agg(*picks, *extra)


def yoy(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    measure: str,
    prior: str = "prior_year",
    change: str = "yoy_change",
    growth: str = "growth_pct",
) -> DataFrame:
    """Previous value of the group, the change and the change in percent (4 digits).

    ``df`` has one row per group and year, so each group is a few dozen rows.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    before = F.col(prior)
    delta = F.col(measure) - before
    return (
        df.withColumn(prior, F.lag(measure).over(window))
        .withColumn(change, delta)
        .withColumn(growth, F.round(F.try_divide(delta, before) * 100, 4))
    )


def with_key(
    df: DataFrame, order: list[str], name: str, known: DataFrame | None = None
) -> DataFrame:
    """Number the rows 1, 2, 3, … in ``order`` (nulls last) without a single-task sort.

    With ``known`` (``order`` and ``name`` of an earlier build, one row each) rows that it has keep
    their number, whatever else is new or gone, and new ones are numbered after the largest.

    Spark sorts by range over all tasks. ``monotonically_increasing_id`` then holds the
    sort partition in its upper bits and the row's place in it in the lower 33, and
    the rows before each partition are added up from one count per partition. The
    sorted rows are written first, so counts and rows come from the same sort.
    """
    if known is not None:
        known = known.select(*order, F.col(name).cast("long").alias(name))
        largest = known.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]
        df = materialise(_known_keys(df, known, order, name), f"{name}-known")
        new = with_key(df.where(F.col(name).isNull()).drop(name), order, name)
        new = new.withColumn(name, F.col(name) + largest)
        return df.where(F.col(name).isNotNull()).unionByName(new)
    sorted_rows = df.orderBy(*[F.col(c).asc_nulls_last() for c in order])
    rows = materialise(sorted_rows.withColumn("_id", F.monotonically_increasing_id()), name)
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    rows = rows.withColumns({"_part": F.shiftright("_id", 33), "_place": place})
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # One row per sort partition: its number is bounded by spark.sql.shuffle.partitions.
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    return (
        rows.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_place") + 1)
        .drop("_id", "_part", "_place", "_before")
    )


def _known_keys(df: DataFrame, known: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with the known keys, null for new rows; nulls in ``order`` are values."""
    renamed = known.withColumnsRenamed({c: f"_known_{c}" for c in order})
    same = [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in order]
    return df.drop(name).join(renamed, reduce(lambda a, b: a & b, same), "left").select(
        *[c for c in df.columns if c != name], name
    )
