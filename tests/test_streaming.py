"""Streamed ingest: batches, late rows, replays and compaction."""

from __future__ import annotations

from functools import partial

from areaneed.operators.groups import latest_per_key
from areaneed.streaming import ingest

SCHEMA = "k string, status string, t int"


def land(spark, folder, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_stream(spark, tmp_path):
    landed, target = str(tmp_path / "in"), str(tmp_path / "out")
    schema = spark.createDataFrame([], SCHEMA).schema
    take = partial(
        ingest.stream_ingest, spark, landed, schema, target, f"{target}/cp", ["k"], "t",
        files_per_batch=1,
    )
    state = partial(ingest.current_state, spark, target, ["k"], "t")

    def seen():
        return {(r.k, r.status, r.t) for r in state().collect()}

    land(spark, landed, [("a", "new", 1), ("a", "open", 2), ("b", "new", 1), (None, "x", 9)])
    take()
    assert seen() == {("a", "open", 2), ("b", "new", 1)}
    take()  # nothing arrived
    assert seen() == {("a", "open", 2), ("b", "new", 1)}

    ingest.compact(spark, target, ["k"], "t")
    land(spark, landed, [("a", "late", 1), ("b", "shut", 3), ("c", "new", 3)])
    take()
    expected = {("a", "open", 2), ("b", "shut", 3), ("c", "new", 3)}
    assert seen() == expected

    replayed = spark.createDataFrame([("a", "late", 1), ("b", "shut", 3), ("c", "new", 3)], SCHEMA)
    newest = partial(latest_per_key, keys=["k"], order_col="t", ties=None)
    last = ingest.committed(spark, f"{target}/changes", "batch")[-1]
    ingest._write_batch(replayed, last, target, newest)
    assert seen() == expected

    ingest.compact(spark, target, ["k"], "t")
    assert seen() == expected
    ingest.compact(spark, target, ["k"], "t")  # nothing since
    assert seen() == expected
