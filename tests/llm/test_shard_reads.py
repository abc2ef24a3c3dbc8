"""How written shards are read back."""

from __future__ import annotations

from areaneed.llm.sharding import shuffle_shards


def test_written_shards_are_read_back_without_a_shuffle(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat(sha(cast(id as string)), 10) as text")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # Below the size of the written shards, above that of one row a bucket.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "40000")
    try:
        rows = shuffle_shards(docs, shards=4, bucket_bytes=20_000)
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning" not in plan
    slots = sorted((r["shard"], r["slot"]) for r in rows.collect())
    sizes = [sum(s == i for s, _ in slots) for i in range(4)]
    assert sum(sizes) == 3000 and slots == [(i, j) for i in range(4) for j in range(sizes[i])]
