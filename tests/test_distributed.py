"""Sorted merges and ranks that run over many tasks, beside the plain windows and joins."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from areaneed.operators import groups, merge, quality
from areaneed.sources.readers import lost_values, split_landed_json
from areaneed.sources.schemas import _schema

START = dt.datetime(2024, 1, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def at(hours: float) -> dt.datetime:
    return START + dt.timedelta(hours=hours)


def test_as_of_merge_beside_a_loop(spark):
    """One key has 1,000 versions and a third of the events; some moments are shared by many."""
    rng = random.Random(1)
    versions = [("hot", f"v{i}", at(i), at(i + 1) if i < 999 else None) for i in range(1000)]
    versions += [(f"k{j}", f"{j}-{i}", at(10 * i), at(10 * i + 7)) for j in range(20) for i in range(5)]
    versions += [(None, "no key", at(0), None)]
    events = [(i, "hot", at(rng.uniform(-5, 1010))) for i in range(1000)]
    events += [(i, f"k{rng.randrange(25)}", at(rng.randrange(60))) for i in range(1000, 2600)]
    events += [(i, "hot", at(500)) for i in range(2600, 3000)]
    events += [(3000, None, at(1)), (3001, "hot", None)]
    history = spark.createDataFrame(versions, "key string, status string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    asked = spark.createDataFrame(events, "id long, key string, ts timestamp_ntz").repartition(7)
    found = merge.scd2_at_events(asked, history, "key", "ts", ["status"]).collect()
    by_key: dict = {}
    for key, status, start, end in versions:
        by_key.setdefault(key, []).append((start, end, status))

    def status(key, ts):
        if key is None or ts is None:
            return None
        return next((s for a, b, s in by_key.get(key, []) if a <= ts and (b is None or ts < b)), None)

    assert {tuple(r) for r in found} == {(i, k, t, status(k, t)) for i, k, t in events}
    assert len(found) == len(events)


def test_as_of_merge_has_no_join_of_events_with_versions(spark):
    events = spark.createDataFrame([(1, at(1))], "key long, ts timestamp_ntz")
    history = events.select("key", F.lit("a").alias("s"), F.col("ts").alias("valid_from"),
                            F.lit(None).cast("timestamp_ntz").alias("valid_to"))
    text = plan(merge.scd2_at_events(events, history, "key", "ts", ["s"]))
    assert "SortMergeJoin" not in text and "NestedLoop" not in text
    assert text.count("FileScan") <= 3 and "Window" in text
    empty = merge.scd2_at_events(events.limit(0), history, "key", "ts", ["s"])
    assert empty.count() == 0
    bare = merge.scd2_at_events(events, history.limit(0), "key", "ts", ["s"]).first()
    assert (bare["key"], bare["s"]) == (1, None)


@pytest.mark.parametrize("partition", [[], ["g"], ["g", "h"]])
def test_percent_rank_is_that_of_the_window(spark, partition):
    rng = random.Random(2)
    values = [None, 0.0, -0.0, 1.5, float("inf"), 7.0] + [float(i) for i in range(40)]
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, None]), rng.choice(values), i) for i in range(700)]
    rows += [("one", 5, 3.0, 701), ("tie", 5, 3.0, 702), ("tie", 5, 3.0, 703)]
    df = spark.createDataFrame(rows, "g string, h int, v double, i int").repartition(6)
    window = Window.partitionBy(*(partition or [F.lit(1)])).orderBy("v")
    want = df.withColumn("p", F.percent_rank().over(window)).select("i", "p").collect()
    ranked = groups.percent_rank(df, "v", partition, "p")
    assert ranked.columns == [*df.columns, "p"]
    assert sorted(map(tuple, ranked.select("i", "p").collect())) == sorted(map(tuple, want))
    assert groups.percent_rank(df.limit(0), "v", partition, "p").count() == 0


def test_percent_rank_over_all_rows_is_not_one_task(spark):
    df = spark.range(100_000).select((F.col("id") * 7919 % 1000).alias("v"), "id")
    text = plan(groups.percent_rank(df, "v", [], "p"))
    windows = [i for i, x in enumerate(text.splitlines()) if " Window " in x or "- Window" in x]
    assert windows and "Exchange SinglePartition" not in "\n".join(text.splitlines()[windows[0]:windows[0] + 4])


def test_unique_has_one_exchange_of_values(spark):
    rows = [(1, "a", None), (1, "b", None), (2, "b", 1.0), (3, "b", 1.0), (None, "c", 2.0), (None, "c", 2.5)]
    df = spark.createDataFrame(rows, "x int, y string, z double")
    out = quality.dq_unique(df, ["x", "y", "z"])
    assert plan(out).count("Exchange hashpartitioning") == 1
    assert [tuple(r) for r in out.collect()] == [("unique x", 1), ("unique y", 2), ("unique z", 1)]
    assert [r["failing_rows"] for r in quality.dq_unique(df.limit(0), ["x", "y"]).collect()] == [0, 0]


def test_known_rows_keep_their_keys(spark):
    frame = lambda rows: spark.createDataFrame(rows, "a string, b int")
    first = groups.with_key(frame([("m", 1), ("x", None), (None, 2)]), ["a", "b"], "k")
    keys = {tuple(r)[:2]: r["k"] for r in first.collect()}
    more = frame([("b", 1), ("m", 1), ("x", None), (None, 2), (None, None)])
    again = {tuple(r)[:2]: r["k"] for r in groups.with_key(more, ["a", "b"], "k", first).collect()}
    assert {k: again[k] for k in keys} == keys
    assert again[("b", 1)] == 4 and again[(None, None)] == 5
    fewer = groups.with_key(frame([("x", None), ("y", 0)]), ["a", "b"], "k", first).collect()
    assert {tuple(r)[:2]: r["k"] for r in fewer} == {("x", None): keys[("x", None)], ("y", 0): 4}
    same = groups.with_key(more, ["a", "b"], "k", first.limit(0))
    assert sorted(r["k"] for r in same.collect()) == [1, 2, 3, 4, 5]


def test_accepted_and_rejected_records_are_all_that_landed(spark, tmp_path):
    lines = ['{"a":"1","b":"x"}', '{"a":"2"', "no json", '{"a":null}', '[{"a":"3"},{"a":"4"}]', "[]", '{"c":"other"}']
    (tmp_path / "page.json").write_text("\n".join(lines) + "\n")
    schema = _schema("a string, b string")
    accepted, rejected = split_landed_json(spark, str(tmp_path), schema)
    assert sorted(str(r["a"]) for r in accepted.collect()) == ["1", "3", "4", "None", "None"]
    assert sorted(r["_corrupt"] for r in rejected.collect()) == ["no json", '{"a":"2"']
    assert {r["file"] for r in rejected.collect()} == {"page.json"}


def test_lost_values_name_what_staging_cannot_read(spark):
    raw = spark.createDataFrame(
        [(1, "12", "1,0"), (2, "x", None), (3, "N/A", "2"), (4, None, "y")], "k int, n string, m string"
    )
    staged = {"n": F.col("n").try_cast("int"), "m": F.replace("m", F.lit(","), F.lit("")).try_cast("int")}
    lost = lost_values(raw, staged, ["k"], blank=["N/A"]).collect()
    assert sorted(map(tuple, lost)) == [(2, "n", "x"), (4, "m", "y")]
