"""The gate: what breaks a contract leaves the published table in place."""

from __future__ import annotations

import datetime as dt

import pytest
from catalog.inputs import raw_input, raw_table
from catalog.queries import warehouse
from pyspark.sql import functions as F

from areaneed.operators.quality import between, dq_one_current_version, not_null
from areaneed.plans.nightly import TABLES, build_gold, run_to_gold
from areaneed.sources.gate import BrokenContract, publish, published
from areaneed.sources.schemas import _schema

SCHEMA = _schema("k bigint, v int")
RULES = dict(schema=SCHEMA, unique=["k"])


def ids(df):
    return sorted(r["k"] for r in df.collect())


def test_a_breach_leaves_the_old_table(spark, tmp_path):
    root = str(tmp_path)
    frame = lambda rows, kind="k bigint, v int": spark.createDataFrame(rows, kind)
    rules = {**not_null(["k"]), **between("v", 0, 9)}
    assert published(spark, root, "t") is None
    publish(frame([(1, 1), (2, None)]), root, "t", failing=rules, **RULES)
    reader = published(spark, root, "t")
    bad = {
        "between v": [(3, 10), (4, 11), (5, 1)],
        "not_null k": [(None, 1), (6, 1)],
        "unique k": [(7, 1), (7, 2)],
    }
    for rule, rows in bad.items():
        with pytest.raises(BrokenContract) as error:
            publish(frame(rows), root, "t", failing=rules, **RULES)
        assert error.value.breaches == {rule: 2 if rule == "between v" else 1}
        assert ids(published(spark, root, "t")) == [1, 2]
    with pytest.raises(BrokenContract, match="contract v: 1, contract w: 1"):
        publish(frame([(1, "x")], "k bigint, w string"), root, "t", failing=rules, **RULES)
    current = [lambda rows: dq_one_current_version(rows, "v", "flag")]
    flagged = frame([(1, 1), (2, 1)]).withColumn("flag", F.lit(True))
    with pytest.raises(BrokenContract, match="one_current_version v: 1"):
        publish(flagged, root, "t", after=current)
    publish(frame([(8, 1)]), root, "t", failing=rules, **RULES)
    assert ids(published(spark, root, "t")) == [8] and ids(reader) == [1, 2]
    publish(frame([]), root, "t", failing=rules, **RULES)
    assert published(spark, root, "t").count() == 0


def test_counts_come_with_the_write(spark, tmp_path):
    """Every row is made once: the rules do not read the input again."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = spark.range(1000).mapInArrow(count, "id long")
    publish(rows, str(tmp_path), "t", failing=between("id", 0, 999))
    assert made.value == 1000


def raw_of(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return {k: v for k, v in w.raw.items() if k not in ("entities", "history")}


def test_a_landed_day_reaches_gold_and_a_breach_stops_there(spark, sf_dir, tmp_path):
    raw, root = raw_of(spark, sf_dir), str(tmp_path)
    extract = raw_input(spark, sf_dir, "raw_entities_2")
    day, at = dt.date(2024, 2, 1), dt.datetime(2024, 2, 1, 6)
    built = run_to_gold(spark, extract, raw, root, day, at)
    found = published(spark, f"{root}/gold", "dim_business")
    assert found.count() == extract.count() == built.dim_business.count()
    before = {n: published(spark, f"{root}/gold", n).count() for n in TABLES}
    # The next day an entity has two current versions: dim_business breaks, the facts stay.
    history = built.raw["history"]
    doubled = history.unionByName(history.limit(1).withColumn("scd_id", F.lit("other")))
    inputs = {**raw, "entities": built.raw["entities"], "history": doubled}
    inputs["incidents_late"] = raw_table(spark, sf_dir, "raw_incidents_late").limit(10)
    with pytest.raises(BrokenContract) as error:
        build_gold(inputs, at, f"{root}/gold")
    assert error.value.table == "dim_business"
    assert set(error.value.breaches) == {"one_current_version entity_id", "unique business_key"}
    after = {n: published(spark, f"{root}/gold", n).count() for n in TABLES}
    changed = {n for n in TABLES if after[n] != before[n]}
    assert "int_crimes_unified" in changed
    assert not changed & set(TABLES[TABLES.index("dim_business") :])


def test_a_layer_table_is_rebuilt_from_itself_under_open_readers(spark, tmp_path):
    from areaneed.sources.writers import write_layer

    df = spark.createDataFrame([("01", 1), ("1", 2), (None, 3)], "code string, v int")
    first = write_layer(df, "t", "gold", str(tmp_path), partition=["code"])
    assert first.columns == ["code", "v"]
    assert {tuple(r) for r in first.collect()} == {("01", 1), ("1", 2), (None, 3)}
    second = write_layer(
        first.withColumn("v", F.col("v") * 10), "t", "gold", str(tmp_path), ["v"], ["code"]
    )
    assert {tuple(r) for r in second.collect()} == {("01", 10), ("1", 20), (None, 30)}
    assert {r["v"] for r in first.collect()} == {1, 2, 3}
    last = published(spark, f"{tmp_path}/gold", "t").select("v").collect()
    assert {r["v"] for r in last} == {10, 20, 30}
