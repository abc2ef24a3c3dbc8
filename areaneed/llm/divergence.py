"""How the words of each source differ from its language and from the language's other sources.

1. Duplicate-text collapse: within a language identical texts become one text with the number
   of its rows in each source. Copies are put together in the map tasks before the shuffle, so a
   text that a third of all rows hold travels once a task.
2. Each distinct text is cut into terms once; its counts, and one for each of its documents, are
   added to every source that has it, times its rows there. A task keeps sums and hands them on
   whenever it holds ``_MOST_SUMS`` of them, one row a term with its sums by source. These rows
   meet by term, and that one exchange gives the sums of the sources and of the language.
3. Terms in enough documents of a language are kept. All shares are whole numbers of 1 / ``scale``.
4. Sparse pair evaluation: two sources differ by the distance of their shares of an absent
   term, once for each kept term, and by a correction for the terms that one of them has. The
   corrections are added up by blocks of terms, from the terms that occur alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areaneed.llm.words import byte_slices
from areaneed.sources.scratch import materialise

_SUMS = "lang string, term string, entries array<struct<source: string, n: bigint, docs: bigint>>"
_MOST_SUMS = 800_000
_SLICE_BYTES = 4 << 20
_ROWS = 20_000
#: Letters and all bytes beyond ASCII stay, capitals A-Z become small, all else parts terms.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def source_divergence(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    least_docs: int = 30,
    smoothing: int = 5,
    scale: int = 1_000_000_000,
    top: int = 50,
    block_rows: int = 50_000,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for every occurring language and source.

    A language keeps the terms in at least ``least_docs`` of its documents. In a group (a source of a
    language, or the language itself) a kept term has the share 1 + floor(scale * (count +
    smoothing) / (all counts + smoothing * number of kept terms)). Part ``pair``: each other source of
    the language, with the distance of the two sources' shares added up over all kept terms (0 if
    there are none). Part ``term``: the ``top`` terms of a source whose share is above that of the
    language, with the difference. Ranks count from 1, the largest value first, ties by item.

    Null texts, languages and sources are empty strings. A group without terms, even without any
    text, still has its pairs. Repeated rows count each by itself, whatever their ids. Other columns are
    not read, so their names cannot clash. An empty table gives an empty result.
    """
    base = docs.select(
        *[
            F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)
            for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))
        ]
    )
    terms = materialise(
        _term_sums(base).where(F.col("docs") >= least_docs).drop("docs"), "divergence-terms"
    )
    kept = terms.select("lang", "term", "lang_n", F.explode("entries").alias("x"))
    kept = kept.select("lang", "x.source", "term", "x.n", "lang_n")
    sizes = materialise(
        _group_sizes(base.select("lang", "source"), terms, kept), "divergence-sizes"
    )

    def share(n: Column, total: str) -> Column:
        scaled = (n + F.lit(smoothing)).cast("decimal(20,0)") * F.lit(scale).cast("decimal(10,0)")
        return 1 + F.call_function("div", scaled, F.col(total) + smoothing * F.col("v"))

    shares = kept.join(sizes, ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), "total").alias("p"),
        share(F.col("lang_n"), "lang_total").alias("q"),
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    above = (
        shares.where("p > q")
        .select(
            "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
            (F.col("p") - F.col("q")).alias("value"),
        )
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
    )

    blocks = F.greatest(F.lit(1), F.ceil(F.col("entries") / block_rows)).cast("int")
    spread = sizes.select("lang", blocks.alias("blocks")).distinct()
    cells = shares.join(spread, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"),
        "source", "term", "p",
    )
    absent = F.when(F.col("v") > 0, share(F.lit(0), "total")).otherwise(0)
    sources = sizes.select(
        "lang", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), "source",
        absent.alias("p"),
    )
    keys = ["lang", "block"]
    pairs = (
        cells.groupBy(*keys)
        .cogroup(sources.groupBy(*keys))
        .applyInArrow(_block_distances, "lang string, a string, b string, value long")
        .groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("value"))
        .select(
            "lang",
            F.explode(
                F.array(
                    F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                    F.struct(F.col("b").alias("source"), F.col("a").alias("item")),
                )
            ).alias("x"),
            "value",
        )
        .select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
        .withColumn("rank", F.row_number().over(order))
    )
    return pairs.unionByName(above)


def _term_sums(base: DataFrame) -> DataFrame:
    """Each term of a language with its documents (``docs``) and occurrences (``lang_n``) there, and
    the occurrences in each source that has it (``entries``)."""
    keyed = base.withColumn("digest", F.unhex(F.sha2("text", 256)))
    rows = (
        keyed.groupBy("lang", "digest", "source")
        .agg(F.count("*").alias("n"))
        .groupBy("lang", "digest")
        .agg(F.collect_list(F.struct("source", "n")).alias("sources"))
    )
    # Equal digests are equal texts; one is kept in each map task, and one of those by the shuffle.
    texts = keyed.groupBy("lang", "digest").agg(F.min("text").alias("text"))
    # A term has one row a task at most, or one each time a task hands its sums on. Both sums
    # below are by this exchange.
    dealt = (
        texts.join(rows, ["lang", "digest"])
        .select("lang", "sources", "text")
        .mapInArrow(partial(_add_terms, most=_MOST_SUMS), _SUMS)
        .repartition("lang", "term")
    )
    return (
        dealt.select("lang", "term", F.explode("entries").alias("x"))
        .select("lang", "term", "x.*")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .groupBy("lang", "term")
        .agg(
            F.sum("docs").alias("docs"),
            F.sum("n").alias("lang_n"),
            F.collect_list(F.struct("source", "n")).alias("entries"),
        )
    )


def _group_sizes(groups: DataFrame, terms: DataFrame, kept: DataFrame) -> DataFrame:
    """Of each occurring language and source: all counts there and in the language, the number of
    kept terms (``v``) and of their entries in the language's sources."""
    by_source = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_lang = terms.groupBy("lang").agg(
        F.sum("lang_n").alias("lang_total"),
        F.sum(F.size("entries")).alias("entries"),
        F.count("*").alias("v"),
    )
    zero = {"total": 0, "lang_total": 0, "entries": 0, "v": 0}
    return (
        groups.distinct()
        .join(by_source, ["lang", "source"], "left")
        .join(by_lang, "lang", "left")
        .fillna(zero)
    )


def _add_terms(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Sums over a task's distinct texts."""
    sums: dict[tuple, tuple[Counter, Counter]] = {}
    held = 0
    for batch in byte_slices(batches, "text", _SLICE_BYTES):
        langs = batch.column("lang").to_pylist()
        shared = batch.column("sources").to_pylist()
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for lang, sources, text in zip(langs, shared, texts, strict=True):
            words = text.translate(_LETTERS).split()
            counts = None
            for entry in sources:
                n, docs = sums.setdefault((lang, entry["source"]), (Counter(), Counter()))
                held -= len(n)
                if entry["n"] == 1:
                    n.update(words)
                    docs.update(set(words))
                else:
                    counts = counts or Counter(words)
                    for term, k in counts.items():
                        n[term] += k * entry["n"]
                        docs[term] += entry["n"]
                held += len(n)
            if held >= most:
                yield from _sum_rows(sums)
                sums, held = {}, 0
    yield from _sum_rows(sums)


def _sum_rows(sums: dict[tuple, tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    """One row a language and term, ``_ROWS`` at a time."""
    for lang in {lang for lang, _ in sums}:
        own = [(source, *x) for (of, source), x in sums.items() if of == lang]
        sources = pa.array([source for source, _, _ in own], pa.string())
        names = pa.array([x for _, n, _ in own for x in n], pa.binary())
        terms = names.cast(pa.string()).dictionary_encode()
        code = terms.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(code, kind="stable")
        edge = np.searchsorted(code[order], np.arange(len(terms.dictionary) + 1))
        of = np.repeat(np.arange(len(own)), [len(n) for _, n, _ in own])[order]
        n = np.fromiter((k for _, n, _ in own for k in n.values()), np.int64, len(code))[order]
        docs = np.fromiter((d[x] for _, n, d in own for x in n), np.int64, len(code))[order]
        for lo in range(0, len(edge) - 1, _ROWS):
            cut = edge[lo : lo + _ROWS + 1]
            part = slice(cut[0], cut[-1])
            entries = pa.StructArray.from_arrays(
                [sources.take(pa.array(of[part])), pa.array(n[part]), pa.array(docs[part])],
                ["source", "n", "docs"],
            )
            rows = pa.ListArray.from_arrays(pa.array((cut - cut[0]).astype(np.int32)), entries)
            found = terms.dictionary.slice(lo, len(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(rows), pa.string()), found, rows], ["lang", "term", "entries"]
            )


def _block_distances(cells: pa.Table, sources: pa.Table) -> pa.Table:
    """Of each pair of sources a < b: the distance of their shares over the terms of a block.

    With the share d of an absent term, and over the block's terms: the number of terms times
    |d(a) - d(b)|; plus |p(a) - d(b)| - |d(a) - d(b)| for each term of a; plus, for each term of b,
    what its own share changes. Whole numbers throughout.
    """
    order = pc.sort_indices(sources.column("source"))
    names = sources.column("source").take(order).combine_chunks()
    absent = sources.column("p").take(order).to_numpy().astype(np.int64)
    lang = sources.column("lang")[0].as_py()
    terms = cells.column("term").combine_chunks().dictionary_encode()
    n_terms = len(terms.dictionary)
    source = pc.index_in(cells.column("source"), value_set=names).to_numpy().astype(np.int64)
    by_source = np.argsort(source, kind="stable")
    source = source[by_source]
    term = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)[by_source]
    p = cells.column("p").to_numpy().astype(np.int64)[by_source]
    edge = np.searchsorted(source, np.arange(len(names) + 1))
    first, second, values = [], [], []
    for a in range(len(names) - 1):
        lo, hi = edge[a], edge[a + 1]
        rest = slice(edge[a + 1], len(p))  # entries of the sources after a
        own = np.full(n_terms, absent[a])
        own[term[lo:hi]] = p[lo:hi]
        has = np.zeros(n_terms, bool)
        has[term[lo:hi]] = True
        mine, other = own[term[rest]], absent[source[rest]]
        # An entry of b takes the place of b's absent share, which is counted below for terms of a
        # by their own share and for all others by a's absent share.
        change = np.abs(mine - p[rest]) - np.abs(mine - other)
        total = np.concatenate([[0], np.cumsum(change)])
        later = np.arange(a + 1, len(names))
        value = total[edge[a + 2 :] - edge[a + 1]] - total[edge[a + 1 : -1] - edge[a + 1]]
        value += (n_terms - (hi - lo)) * np.abs(absent[a] - absent[later])
        value += _distances(p[lo:hi], absent[later])
        first.append(np.full(len(later), a))
        second.append(later)
        values.append(value)
    pick = lambda x: names.take(pa.array(np.concatenate([*x, np.zeros(0, int)]), pa.int64()))
    a, b = pick(first), pick(second)
    return pa.table(
        {
            "lang": pa.array([lang] * len(a), pa.string()),
            "a": a,
            "b": b,
            "value": pa.array(np.concatenate([*values, np.zeros(0, np.int64)]), pa.int64()),
        }
    )


def _distances(values: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The sum of the distances of all ``values`` to each of ``points``."""
    ranked = np.sort(values)
    before = np.concatenate([[0], np.cumsum(ranked)])
    below = np.searchsorted(ranked, points)
    return points * (2 * below - len(ranked)) + before[-1] - 2 * before[below]
