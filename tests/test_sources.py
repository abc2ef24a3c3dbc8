"""Readers, landing, versions and the daily run."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from areaneed.plans import daily
from areaneed.sources import readers, schemas, versions, writers


def test_seed_with_bom_crlf_and_null_tokens(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_bytes(
        "﻿zip_code,city,county\r\n80202,Denver,Denver\r\nNULL,null,\r\n"
        '80301,"Boulder, North",Boulder\r\n'.encode()
    )
    seed = readers.read_seed(spark, str(path), schemas.ZIP_SEED)
    assert seed.schema == schemas.ZIP_SEED
    assert set(map(tuple, seed.collect())) == {
        (80202, "Denver", "Denver"),
        (None, None, None),
        (80301, "Boulder, North", "Boulder"),
    }


@pytest.mark.parametrize("indent", [None, 2])
def test_json_pages(spark, tmp_path, indent):
    pages = [[{"entityid": "1", "entityname": "a"}, {"entityid": "2"}], [{"entityid": "3"}], []]
    for i, page in enumerate(pages):
        (tmp_path / f"page{i}.json").write_text(json.dumps(page, indent=indent))
    batch = readers.read_landed_json(
        spark, f"{tmp_path}/page*.json", schemas.RAW_ENTITY, multi_line=indent is not None
    )
    found = {(r.entityid, r.entityname) for r in batch.where("entityid is not null").collect()}
    assert found == {("1", "a"), ("2", None), ("3", None)}


def batch(spark, data):
    return spark.createDataFrame(data, "id int, source_date date")


def test_landing_is_idempotent_and_empty_batches_change_nothing(spark, tmp_path):
    root = str(tmp_path / "landed")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    writers.overwrite_partition(batch(spark, [(1, d1), (2, d1), (3, d2)]), root)
    writers.overwrite_partition(batch(spark, [(4, d1)]), root)
    assert not writers.overwrite_partition(batch(spark, []), root)
    assert {r.id for r in readers.read_landed(spark, root).collect()} == {3, 4}
    assert {r.id for r in readers.read_landed(spark, root, d2).collect()} == {3}


def test_landed_files_with_other_columns_are_matched_by_name(spark, tmp_path):
    root = str(tmp_path / "landed")
    spark.range(1).select("id", F.lit("x").alias("a")).write.parquet(f"{root}/source_date=2024-01-01")
    spark.range(1).select(F.lit("y").alias("b"), "id").write.parquet(f"{root}/source_date=2024-01-02")
    found = {(r.a, r.b) for r in readers.read_landed(spark, root).collect()}
    assert found == {("x", None), (None, "y")}


def test_no_rows_landed(spark):
    df = batch(spark, [(1, dt.date(2024, 1, 1))])
    assert writers.assert_rows_landed(df, "2024-01-01").count() == 1
    with pytest.raises(writers.NoRowsLanded):
        writers.assert_rows_landed(df, "2024-01-02")


def test_versions_ignore_incomplete_writes(spark, tmp_path):
    root = str(tmp_path / "t")
    assert versions.read_version(spark, root) is None
    versions.write_version(spark.range(1), root, 1)
    versions.write_version(spark.range(2), root, 2)
    (tmp_path / "t" / "version=3").mkdir()
    assert versions.committed(spark, root) == [1, 2]
    assert versions.read_version(spark, root).count() == 2
    versions.write_version(spark.range(5), root, 2)
    assert versions.read_version(spark, root).count() == 5


def entity(key, status="Good Standing"):
    names = [f.name for f in schemas.RAW_ENTITY]
    row = dict.fromkeys(names) | {
        "entityid": key,
        "entityname": f"name {key}",
        "principalstate": "CO",
        "entitystatus": status,
        "entityformdate": "2020-01-15",
    }
    return tuple(row[n] for n in names)


def test_daily_run_can_be_repeated(spark, tmp_path):
    root = str(tmp_path)
    days = [
        (dt.date(2024, 1, 1), [entity("1"), entity("2"), entity("2"), entity(None)]),
        (dt.date(2024, 1, 2), [entity("2", "Delinquent"), entity("3")]),
    ]

    def run(day, data):
        extract = spark.createDataFrame(data, schemas.RAW_ENTITY)
        at = dt.datetime.combine(day, dt.time(6))
        return daily.run_day(spark, extract, root, day, at)

    for day, data in days:
        history = run(day, data)
    expected = {
        (1, "Good Standing", 1, None),
        (2, "Good Standing", 1, 2),
        (2, "Delinquent", 2, None),
        (3, "Good Standing", 2, None),
    }

    def seen(df):
        return {
            (r.entity_id, r.entity_status, r.valid_from.day, r.valid_to and r.valid_to.day)
            for r in df.collect()
        }

    assert seen(history) == expected
    assert seen(run(*days[1])) == expected
    with pytest.raises(writers.NoRowsLanded):
        run(dt.date(2024, 1, 3), [])


def test_daily_run_in_any_order(spark, tmp_path):
    """A late day, a corrected day and two rows of one key end as if landed in order."""
    days = {
        dt.date(2024, 1, 1): [entity("1"), entity("2")],
        dt.date(2024, 1, 2): [entity("2", "Delinquent"), entity("2", "Exists"), entity("3")],
        dt.date(2024, 1, 3): [entity("1", "Exists")],
    }

    def run(root, day, data):
        extract = spark.createDataFrame(data, schemas.RAW_ENTITY)
        at = dt.datetime.combine(day, dt.time(6))
        return daily.run_day(spark, extract, str(tmp_path / root), day, at)

    def seen(df):
        return sorted(map(str, df.collect()))

    with pytest.raises(writers.NoRowsLanded):
        run("empty", dt.date(2024, 1, 1), [])
    first, second, third = days
    for day in days:
        straight = run("straight", day, days[day])
    run("mixed", first, [entity("1", "Noncompliant")])
    run("mixed", third, days[third])
    run("mixed", second, days[second][::-1])
    assert seen(run("mixed", first, days[first])) == seen(straight)
