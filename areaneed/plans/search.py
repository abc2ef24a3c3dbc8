"""Search in names through an inverted index of trigrams.

``build_index`` writes three tables: the rows by a hash of their id, the postings (trigram of the
name in capitals, id) by a hash of the trigram, and how many names each trigram has. A search reads
the postings of the rarest trigrams of its term, keeps the ids that all of them name, and verifies the
names of just these, in the parts of the row table they lie in. An id is looked up in its own part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaneed.plans.portal import SEARCH_ROWS
from areaneed.sources.keyed import PART, key_part, with_part

GRAM_PART = "gram_part"
_POSTINGS = f"gram string, id string, {PART} int, {GRAM_PART} int"


def trigrams(text: Column) -> Column:
    """The different runs of three characters of a text; none if it is shorter or null."""
    n = F.length(text)
    places = F.when(n >= 3, F.sequence(F.lit(1), n - 2)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(3))))


@dataclass(frozen=True)
class NameIndex:
    spark: SparkSession
    root: str
    schema: T.StructType
    id_col: str
    name_col: str
    parts: int

    def rows(self) -> DataFrame:
        return self.spark.read.schema(with_part(self.schema)).parquet(f"{self.root}/rows")

    def postings(self) -> DataFrame:
        return self.spark.read.schema(_POSTINGS).parquet(f"{self.root}/postings")

    def search(self, term: str, max_rows: int = SEARCH_ROWS, rarest: int = 3) -> DataFrame | None:
        """As ``portal.search_businesses``: digits find that id; anything else, or no such id, a
        part of the name. A term of fewer than three characters has no trigram and is searched in all
        names. ``rarest`` bounds the postings read and changes no answer."""
        term = term.strip()
        if not term:
            return None
        rows = self.rows()
        if term.isdecimal() and str(int(term)) == term and int(term) < 1 << 63:
            own = key_part(F.lit(term), self.parts)
            by_id = rows.where((F.col(PART) == own) & (F.col(self.id_col) == int(term)))
            if not by_id.isEmpty():
                return self._first(by_id, max_rows)
        text = term.upper()
        if len(text) >= 3:
            ids = self._candidates(sorted({text[i : i + 3] for i in range(len(text) - 2)}), rarest)
            parts = [r[0] for r in ids.select(PART).distinct().collect()]  # at most self.parts
            rows = self._semi(rows.where(F.col(PART).isin(parts)), ids)
        found = rows.where(F.contains(F.upper(F.col(self.name_col)), F.lit(text)))
        return self._first(found, max_rows)

    def _candidates(self, grams: list[str], rarest: int) -> DataFrame:
        """Ids, with their part, that all of the rarest of ``grams`` name."""
        counts = self.spark.read.parquet(f"{self.root}/counts").where(F.col("gram").isin(grams))
        known = counts.orderBy("n", "gram").limit(rarest).collect()
        postings = self.postings()
        if counts.count() < len(grams):
            return postings.where("false").select(PART, "id")
        some, of = [r["gram"] for r in known], sorted({r[GRAM_PART] for r in known})
        read = postings.where(F.col(GRAM_PART).isin(of) & F.col("gram").isin(some))
        named = read.groupBy(PART, "id").agg(F.count("*").alias("n"))
        return named.where(F.col("n") == len(some)).select(PART, "id")

    def _semi(self, rows: DataFrame, ids: DataFrame) -> DataFrame:
        keyed = rows.withColumn("id_text", F.col(self.id_col).cast("string"))
        return keyed.join(
            ids.withColumnRenamed("id", "id_text"), [PART, "id_text"], "left_semi"
        ).drop("id_text")

    def _first(self, found: DataFrame, max_rows: int) -> DataFrame:
        ordered = found.orderBy(self.name_col, self.id_col).limit(max_rows)
        return ordered.select(*self.schema.names)


def build_index(
    lookup: DataFrame,
    root: str,
    id_col: str = "entity_id",
    name_col: str = "entity_name",
    parts: int = 64,
) -> NameIndex:
    """Write the index of ``lookup`` under ``root``.

    Postings are dealt by ranges of trigram and id, so a trigram that most names have is written
    by several tasks. Rows without an id or name have no postings: without an id they are not found
    by name either.
    """
    rows = lookup.where(F.col(id_col).isNotNull()).withColumn(PART, key_part(id_col, parts))
    rows.repartition(PART).write.partitionBy(PART).parquet(f"{root}/rows")
    index = NameIndex(lookup.sparkSession, root, lookup.schema, id_col, name_col, parts)
    postings = index.rows().select(
        F.explode(trigrams(F.upper(F.col(name_col)))).alias("gram"),
        F.col(id_col).cast("string").alias("id"),
        PART,
    )
    postings = postings.distinct().withColumn(GRAM_PART, key_part("gram", parts))
    order = [GRAM_PART, "gram", "id"]
    (
        postings.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.partitionBy(GRAM_PART)
        .parquet(f"{root}/postings")
    )
    counts = index.postings().groupBy("gram", GRAM_PART).agg(F.count("*").alias("n"))
    counts.write.parquet(f"{root}/counts")
    return index
