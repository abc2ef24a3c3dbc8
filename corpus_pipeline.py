"""From raw documents to packed sequences, one operator a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaneed.llm.decontam import decontaminate
from areaneed.llm.jaccard import jaccard_components
from areaneed.llm.packing import harmonic_pack
from areaneed.llm.quality import classify
from areaneed.llm.queries import read, tokenizer_path
from areaneed.llm.substring import substring_dedup
from areaneed.sources.scratch import materialise

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents judged of poor quality or toxic go."""
    judged = classify(
        docs, read(spark, sf_dir, "labels"), host=F.col("source"), path=F.col("lang")
    )
    return judged.where("keep").select(*DOCUMENT)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    groups = jaccard_components(docs.select("doc_id", "text"), n=5, similarity=(3, 4))
    copies = groups.where("component_id <> doc_id").select("doc_id")
    return docs.join(copies, "doc_id", "left_anti").select(*DOCUMENT)


def remove_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words that an earlier document has are cut out."""
    kept = substring_dedup(docs, window=50)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    judged = decontaminate(docs, read(spark, sf_dir, "benchmark"), window=10, k=5)
    return judged.where("not contaminated").select(*DOCUMENT)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens; workers keep few encoded words, as other stages share them."""
    pieces = harmonic_pack(
        docs, tokenizer_path(), end_id=2, capacity=4096, store_bytes=12 << 20
    )
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


STAGES = [
    ("quality classifier", drop_poor),
    ("n-gram Jaccard join", drop_copies),
    ("substring dedup", remove_passages),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn; each one's result is written and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
