"""Benchmark decontamination by winnowing, in DataFrame functions only.

1. Each text is lower-cased and cut into words; the runs of ``k`` words are hashed, and of every
   ``window - k + 1`` neighbouring hashes the smallest is kept. Two texts that share ``window``
   words share all hashes of that stretch, so they share the one kept there: no shared
   stretch is missed.
2. Kept hashes of the documents meet those of the benchmark. What leaves the scan is a pair of
   longs a hash; the texts stay where they are.
3. Only documents with a hit are read again. Each hit is extended to the windows of words around
   it, and these are compared word by word with the benchmark's windows.

Items shorter than a window have one window, the whole item; all runs of that many words are
hashed, for the lengths that occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaneed.sources.scratch import materialise

# Words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+; a split at what lies between costs far less than
# extracting every match.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ARRAY = "array<bigint>"


def words(text: Column) -> Column:
    """Words of a text, with A-Z in lower case and nothing else changed."""
    return _cut(F.translate(text, _UPPER, _LOWER))


def _cut(text: Column) -> Column:
    """Words of a text; the split gives an empty one before a leading and after a last gap."""
    return F.array_remove(F.split(text, _BETWEEN), "")


def _coarse_words(text: Column) -> Column:
    """As ``words``, but with every letter in lower case: much faster, the same word borders,
    and equal wherever ``words`` are equal. Good for finding candidates."""
    return _cut(_lower(text))


def _lower(text: Column) -> Column:
    """Lower case of each letter by itself. Only that of the capital sigma depends on the letters
    beside it, so it is replaced first: a text and its words taken alone give the same."""
    return F.lower(F.replace(text, F.lit("Σ"), F.lit("σ")))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once a row: Spark may put a column's expression in
    the place of its name, and inside a lambda that would compute it for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _span(first: int, last: Column) -> Column:
    """first .. last, empty when last is smaller."""
    return F.when(last >= first, F.sequence(F.lit(first), last)).otherwise(F.array().cast("array<int>"))


def _with_hashes(df: DataFrame, k: int) -> DataFrame:
    """Adds ``h`` (hash of each word of ``w``) and ``g`` (of each run of ``k`` words)."""
    df = df.withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    run = lambda i: F.xxhash64(*[F.get("h", i + j) for j in range(k)])
    return df.withColumn("g", F.transform(_span(0, F.size("h") - k), run))


def _kept(df: DataFrame, width: int) -> DataFrame:
    """Adds ``f``: the smallest of each ``width`` neighbouring hashes of ``g``, each once."""
    least = lambda i: F.least(*[F.get("g", i + j) for j in range(width)])
    windows = F.transform(_span(0, F.size("g") - width), least)
    return df.withColumn("f", F.array_distinct(windows))


def _runs_of(length: int) -> Column:
    """Hashes of all runs of ``length`` words."""
    run = lambda i: F.xxhash64(*[F.get("h", i + j) for j in range(length)])
    return F.transform(_span(0, F.size("h") - length), run)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    k: int = 5,
) -> DataFrame:
    """``docs`` plus ``n_words``, ``n_hit``, ``items`` (sorted as strings) and ``contaminated``.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one
    window. ``n_hit`` counts the document's words inside any occurrence of a window.

    Null and empty texts have no words: such documents are clean, such items match nothing.
    Equal items each count. A row with a null id is judged like any other; rows with equal ids are
    judged by their own texts; an item with a null id adds hits but no entry of ``items``.
    Other columns pass through; input columns named like the results are replaced by them.
    Either table may be empty.
    """
    if not 1 < k <= window:
        raise ValueError("k must be from 2 to window")
    new = ["n_words", "n_hit", "items", "contaminated"]
    keep = [c for c in docs.columns if c not in new]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    id_ = F.col(f"`{id_col}`")

    item_words = materialise(
        benchmark.select(
            F.col(f"`{item_col}`").cast("string").alias("item"),
            words(F.col(f"`{item_text_col}`").cast("string")).alias("w"),
        ).where(F.size("w") > 0),
        "benchmark-words",
    )
    n = F.size("w")
    windows = materialise(
        item_words.select(
            "item",
            F.explode(
                F.when(n < window, F.array(F.struct(F.col("w").alias("w")))).otherwise(
                    F.transform(
                        _span(1, n - (window - 1)),
                        lambda i: F.struct(F.slice("w", i, window).alias("w")),
                    )
                )
            ).alias("x"),
        )
        .select(F.array_join("x.w", " ").alias("words"), "item")
        .distinct(),
        "benchmark-windows",
    )
    coarse = item_words.select(F.transform("w", lambda x: _lower(x)).alias("w"))
    marks = _kept(_with_hashes(coarse.where(n >= window), k), window - k + 1).select(
        F.lit(window).alias("length"), F.explode_outer("f").alias("f")
    ).where("f is not null")
    # At most window - 1 numbers.
    lengths = sorted(r[0] for r in item_words.where(n < window).select(n).distinct().collect())
    for length in lengths:
        few = coarse.where(n == length).withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
        few = few.select(F.lit(length).alias("length"), F.xxhash64(*_at(length)).alias("f"))
        marks = marks.union(few)
    marks = materialise(marks.distinct(), "benchmark-marks")

    # Short texts give no hashes. A filter on their size would be pushed down and cut every
    # text a second time.
    scanned = docs.select(
        id_.alias("id"), F.xxhash64(text).alias("text_hash"), _coarse_words(text).alias("w")
    )
    scanned = _kept(_with_hashes(scanned, k), window - k + 1)
    tagged = [_tag(F.col("f"), window)] + [_tag(_runs_of(x), x) for x in lengths]
    # Outer, as Spark would test the array of an inner explode first, and for that
    # compute it anew at every place it is used. The joins drop the nulls.
    hits = (
        scanned.select("id", "text_hash", F.explode_outer(F.concat(*tagged)).alias("m"))
        .select("id", "text_hash", "m.length", "m.f")
        .join(marks, ["length", "f"])
        .groupBy("id", "text_hash")
        .agg(
            *[
                F.collect_set(F.when(F.col("length") == x, F.col("f"))).alias(f"m{x}")
                for x in [window, *lengths]
            ]
        )
    )
    hits = materialise(hits, "benchmark-hits")

    again = docs.select(id_.alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    again = again.alias("d").join(
        hits.alias("m"),
        F.col("d.id").eqNullSafe(F.col("m.id")) & (F.col("d.text_hash") == F.col("m.text_hash")),
    )
    found = again.select(
        "d.id", "d.text_hash", "d.text", *[F.col(f"m.m{x}") for x in [window, *lengths]]
    ).dropDuplicates(["id", "text_hash"])
    found = found.withColumn("w", _coarse_words(F.col("text")))
    found = _with_hashes(found, k)
    starts = _let(
        F.col("g"),
        lambda g: F.flatten(
            F.transform(
                F.filter(
                    _span(0, n - k), lambda i: F.array_contains(f"m{window}", F.get(g, i))
                ),
                lambda i: F.sequence(
                    F.greatest(F.lit(0), i - (window - k)),
                    F.greatest(F.lit(0), F.least(i, n - window)),
                ),
            )
        ),
    )
    spans = [_places(F.array_distinct(starts), window)]
    for x in lengths:
        found = found.withColumn(f"g{x}", _runs_of(x))
        spans.append(_places(_marked(x, n), x))
    found = found.select(
        "id", "text_hash", words(F.col("text")).alias("w"), F.concat(*spans).alias("spans")
    )
    candidates = found.select(
        "id",
        "text_hash",
        F.explode_outer(
            _let(
                F.col("w"),
                lambda w: F.transform(
                    "spans",
                    lambda s: F.struct(
                        s["start"].alias("start"),
                        s["length"].alias("length"),
                        F.array_join(F.slice(w, s["start"] + 1, s["length"]), " ").alias("words"),
                    ),
                ),
            )
        ).alias("s"),
    ).select("id", "text_hash", "s.*")
    # collect_set leaves null items out.
    judged = (
        candidates.join(windows, "words")
        .groupBy("id", "text_hash")
        .agg(
            F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans"),
            F.sort_array(F.collect_set("item")).alias("items"),
        )
        .select("id", "text_hash", _covered().alias("n_hit"), "items")
    )
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        id_.alias("id"),
        F.xxhash64(text).alias("text_hash"),
        F.size(_coarse_words(text)).cast("long").alias("n_words"),
    )
    out = base.alias("b").join(
        materialise(judged, "benchmark-judged").alias("j"),
        F.col("b.id").eqNullSafe(F.col("j.id")) & (F.col("b.text_hash") == F.col("j.text_hash")),
        "left",
    )
    return out.select(
        "b.row.*",
        "b.n_words",
        F.coalesce("j.n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("j.items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.col("j.n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def _at(length: int) -> list[Column]:
    return [F.get("h", F.lit(j)) for j in range(length)]


def _tag(hashes: Column, length: int) -> Column:
    return F.transform(
        hashes, lambda x: F.struct(F.lit(length).alias("length"), x.alias("f"))
    )


def _marked(length: int, n: Column) -> Column:
    """Where a run of ``length`` of the ``n`` words has a hash found in the benchmark."""
    return _let(
        F.col(f"g{length}"),
        lambda g: F.filter(
            _span(0, n - length), lambda i: F.array_contains(f"m{length}", F.get(g, i))
        ),
    )


def _places(starts: Column, length: int) -> Column:
    return F.transform(
        starts, lambda i: F.struct(i.alias("start"), F.lit(length).alias("length"))
    )


def _covered() -> Column:
    """Words covered by ``spans`` (start, length), sorted by start."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def step(state, span):
        end = span["start"] + span["length"]
        return F.struct(
            (
                state["n"]
                + F.greatest(F.lit(0), end - F.greatest(state["end"], span["start"]))
            ).alias("n"),
            F.greatest(state["end"], end).alias("end"),
        )

    return F.aggregate("spans", zero, step, lambda state: state["n"])
