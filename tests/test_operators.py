"""Shared operators: properties that hold for any data, and hot keys."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from areaneed.operators import groups, joins, merge, quality
from areaneed.plans import dimensions
from areaneed.sources import schemas, scratch, writers


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_with_key_counts_on_over_sort_partitions(spark):
    values = [f"name {i:05d}" for i in range(5000)] + [None]
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(7)
    keyed = groups.with_key(df, ["v"], "k")
    expected = {v: i + 1 for i, v in enumerate(sorted(v for v in values if v is not None))}
    expected[None] = 5001
    assert {r.v: r.k for r in keyed.collect()} == expected


def test_with_key_really_spans_partitions(spark):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(20000).select((F.col("id") * 7919 % 20011).alias("v"))
        keyed = groups.with_key(df, ["v"], "k")
        ks = [r.k for r in keyed.orderBy("v").collect()]
        assert ks == list(range(1, 20001))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_latest_per_key_trims_hot_keys_before_the_shuffle(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("t"),
    )
    newest = groups.latest_per_key(df, ["k"], "t")
    assert plan(newest).count("WindowGroupLimit") == 2
    result = {r.k: r.t for r in newest.collect()}
    assert result[0] == 29997
    assert len(result) == 20001


def test_latest_per_key_skips_null_keys_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, 1), ("a", 2, 1), ("a", 2, 2), (None, 9, 9), ("b", None, 1)],
        "k string, t int, i int",
    )
    assert rows(groups.latest_per_key(df, ["k"], "t", ["i"])) == [("a", 2, 2), ("b", None, 1)]


def target(spark):
    return spark.createDataFrame(
        [(1, "a", "x", 5), (2, "b", None, 5), (3, "c", "z", 5)], "k int, v string, own string, t int"
    )


def test_upsert_takes_all_matched_values_and_adds_new_rows(spark):
    source = spark.createDataFrame([(2, None, 4), (4, "d", 6)], "k int, v string, t int")
    merged = merge.upsert_by_key(target(spark), source, ["k"])
    expected = {(1, "a", "x", 5), (2, None, None, 4), (3, "c", "z", 5), (4, "d", None, 6)}
    assert set(map(tuple, merged.collect())) == expected
    again = merge.upsert_by_key(merged, source, ["k"])
    assert set(map(tuple, again.collect())) == expected


def test_upsert_newer_by_lets_late_updates_lose(spark):
    source = spark.createDataFrame([(1, "old", 4), (2, "new", 6)], "k int, v string, t int")
    merged = merge.upsert_by_key(target(spark), source, ["k"], newer_by="t")
    assert {(r.k, r.v) for r in merged.collect()} == {(1, "a"), (2, "new"), (3, "c")}


def test_upsert_of_a_small_batch_does_not_shuffle_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100000).select(F.col("id").alias("k"), F.col("id").alias("v")).write.parquet(path)
    source = spark.range(3).select(F.col("id").alias("k"), F.lit(0).cast("bigint").alias("v"))
    merged = merge.upsert_by_key(spark.read.parquet(path), source, ["k"])
    assert "SortMergeJoin" not in plan(merged)
    assert merged.where("v = 0").count() == 3


DAY = "2024-01-0{} 00:00:00"
CHECK = ["status", "name"]


def entities(spark, data):
    return spark.createDataFrame(data, "id int, status string, name string, note string")


def test_scd2_opens_closes_and_reopens(spark):
    day1 = entities(spark, [(1, "on", "a", "n1"), (2, "on", None, "n"), (3, "on", "c", "n")])
    day2 = entities(spark, [(1, "off", "a", "n2"), (2, "on", None, "other"), (4, "on", "d", "n")])
    day3 = entities(spark, [(1, "off", "a", "n2"), (2, "on", "b", "n"), (3, "on", "c", "n"), (4, "on", "d", "n")])
    h = merge.empty_history(day1)
    for n, day in enumerate([day1, day2, day3], start=1):
        h = merge.scd2_snapshot(h, day, "id", CHECK, DAY.format(n))
    seen = {
        (r.id, r.valid_from.day, r.valid_to.day if r.valid_to else None, r.status, r.name, r.note)
        for r in h.collect()
    }
    assert seen == {
        (1, 1, 2, "on", "a", "n1"),
        (1, 2, None, "off", "a", "n2"),
        (2, 1, 3, "on", None, "n"),
        (2, 3, None, "on", "b", "n"),
        (3, 1, 2, "on", "c", "n"),
        (3, 3, None, "on", "c", "n"),
        (4, 2, None, "on", "d", "n"),
    }
    replay = merge.scd2_snapshot(h, day3, "id", CHECK, DAY.format(4))
    assert set(map(tuple, replay.collect())) == set(map(tuple, h.collect()))
    as_of = merge.scd2_as_of(h, "2024-01-02 00:00:00")
    assert {(r.id, r.status) for r in as_of.collect()} == {(1, "off"), (2, "on"), (4, "on")}


def test_scd2_intervals_never_overlap(spark):
    rng = random.Random(7)
    h = None
    for n in range(1, 6):
        day = entities(
            spark,
            [(i, rng.choice("ab"), "n", "x") for i in range(40) if rng.random() < 0.8],
        )
        h = merge.empty_history(day) if h is None else h
        h = scratch.materialise(merge.scd2_snapshot(h, day, "id", CHECK, DAY.format(n)), "h")
    versions = {}
    for r in h.collect():
        versions.setdefault(r.id, []).append((r.valid_from, r.valid_to or dt.datetime.max))
    for spans in versions.values():
        spans.sort()
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
        assert sum(end == dt.datetime.max for _, end in spans) <= 1
    assert h.select("scd_id").distinct().count() == h.count()


def test_drill_across_matches_null_keys(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, a int")
    b = spark.createDataFrame([(None, 3), ("y", 4)], "k string, b int")
    result = set(map(tuple, joins.drill_across([a, b], ["k"]).collect()))
    assert result == {("x", 1, None), (None, 2, 3), ("y", None, 4)}


def test_shares_add_up(spark):
    df = spark.range(30).select((F.col("id") % 3).alias("g"), (F.col("id") + 1).alias("n"))
    total = groups.share_of(df, "n", ["g"]).groupBy("g").agg(F.sum("share_pct").alias("s"))
    assert all(abs(r.s - 100) < 0.1 for r in total.collect())


def test_tiers_rise_with_the_measure(spark):
    df = spark.range(64).select(F.col("id").alias("n"))
    tiers = [r.tier for r in groups.quartile_tier(df, "n").orderBy("n").collect()]
    assert tiers == sorted(tiers)
    assert set(tiers) == {1, 2, 3, 4}


def test_quality_checks(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (1, "b", None), (None, "z", 11), (None, None, 0)], "k int, v string, n int"
    )
    assert rows(quality.dq_not_null(df, ["k", "v"])) == [("not_null k", 2), ("not_null v", 1)]
    assert rows(quality.dq_unique(df, ["k", "v"])) == [("unique k", 1), ("unique v", 0)]
    assert rows(quality.dq_accepted_values(df, "v", ["a", "b"])) == [("accepted_values v", 1)]
    assert rows(quality.dq_between(df, "n", 1, 10)) == [("between n", 2)]
    assert rows(quality.dq_between(df, "n", lo=1)) == [("between n", 1)]
    assert rows(quality.dq_tier_bounds(df, "n", 0, 5)) == [("tier_bounds n", 1)]


def test_orphans_and_versions(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "g int")
    dim = spark.createDataFrame([(2,)], "g int")
    assert rows(quality.dq_orphan_keys(fact, dim, "g")) == [("orphan_keys g", 1)]
    versions = spark.createDataFrame(
        [(1, True), (1, True), (2, True), (2, False), (3, False)], "k int, c boolean"
    )
    assert rows(quality.dq_one_current_version(versions, "k", "c")) == [
        ("one_current_version k", 1)
    ]


@pytest.mark.parametrize(
    ("now", "status"),
    [("2024-01-02 00:00:00", "pass"), ("2024-01-02 00:00:01", "warn"), ("2024-01-03 00:00:01", "error")],
)
def test_freshness(spark, now, status):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "t timestamp_ntz")
    assert quality.dq_freshness(df, "t", now).first().status == status


def test_freshness_of_nothing_is_an_error(spark):
    df = spark.createDataFrame([], "t timestamp_ntz")
    assert quality.dq_freshness(df, "t", "2024-01-01").first().failing_rows == 1


def test_contract(spark):
    df = spark.createDataFrame([("a", "b", 1)], "agency_name string, primary_county string, agency_key int")
    assert quality.contract_breaches(df, schemas.DIM_AGENCY) == ["agency_key"]
    good = df.withColumn("agency_key", F.col("agency_key").cast("bigint"))
    assert quality.contract_breaches(good, schemas.DIM_AGENCY) == []


def test_write_layer_spreads_one_key_and_copies(spark, tmp_path):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(0, 40000, 1, 8).select(F.lit(1).alias("k"), F.lit("copy").alias("v"))
        table = writers.write_layer(df, "t", "gold", str(tmp_path), ["k"])
        sizes = [r["count"] for r in table.groupBy(F.input_file_name()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sum(sizes) == 40000
    assert len(sizes) >= 6
    assert max(sizes) < 15000


def test_write_layer_raw_is_a_view(spark):
    view = writers.write_layer(spark.range(3).toDF("v"), "raw_view_test", "raw")
    assert view.count() == 3
    assert spark.catalog.tableExists("raw_view_test")


def test_counts_of_several_sets_tell_a_null_value_from_an_absent_column(spark):
    rows = [("a", 1, "x"), ("a", None, "x"), (None, 1, "y"), (None, 1, None)]
    df = spark.createDataFrame(rows, "a string, b int, c string")
    sets = {"ab": ["a", "b"], "c": ["c"], "ba": ["b"], "all": []}
    out = {tuple(r) for r in groups.count_sets(df, sets, F.min("b").alias("least")).collect()}
    assert out == {
        ("a", 1, None, "ab", 1, 1), ("a", None, None, "ab", 1, None), (None, 1, None, "ab", 2, 1),
        (None, None, "x", "c", 2, 1), (None, None, "y", "c", 1, 1), (None, None, None, "c", 1, 1),
        (None, 1, None, "ba", 3, 1), (None, None, None, "ba", 1, None),
        (None, None, None, "all", 4, 1),
    }
    for name, keys in sets.items():
        found = groups.count_sets(df, sets).where(F.col("set") == name).select(*keys, "n")
        plain = df.groupBy(*keys).agg(F.count("*").alias("n"))
        assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
    with pytest.raises(ValueError, match="same columns"):
        groups.count_sets(df, {"one": ["a", "b"], "two": ["b", "a"]})


def test_counts_stand_for_their_rows(spark):
    rows = [("x", "b")] * 3 + [("x", "a")] * 3 + [("y", None)]
    df = spark.createDataFrame(rows, "agency_name string, county_name string")
    counts = df.groupBy("agency_name", "county_name").agg(F.count("*").alias("n"))
    assert sorted(dimensions.dim_agency(counts).collect()) == sorted(dimensions.dim_agency(df).collect())
