"""Removal of long passages that occur in an earlier document: super-k-mer partitioning.

1. Each text is cut into runs of consecutive windows that share a minimiser (the smallest
   hash of ``k`` words in the window). Only (minimiser, document, start, length) is shuffled,
   and runs whose minimiser occurs in one document alone end there: equal windows have
   equal minimisers, so none of their windows can occur elsewhere.
2. Each remaining run travels as one packed string of its words to its minimiser's bucket.
   There its windows are sorted by a 128-bit hash of their words, which brings equal windows
   together with the smallest document first.
3. A minimiser with more than ``hot`` runs is dealt over several buckets. A bucket decides
   all but the first document of each window itself; only these firsts meet again, by window.

Nothing is sampled or capped; bucket sizes follow from the counted words. Texts are shuffled
once by document; the same exchange serves steps 2 and 4 (cutting the words).
"""



from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from areaneed.llm.words import U64, chunks, grams, int64, sliding_min, text_column
from areaneed.sources.scratch import materialise

_RUNS = "minimiser long, id long, text_hash long, start int, windows int"
_FOUND = "a long, b long, id long, text_hash long, start int, windows int, decided boolean"


def substring_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 50,
    k: int = 8,
    hot: int = 4096,
    bucket_words: int = 2_000_000,
) -> DataFrame:
    """``docs`` with the text cut, plus ``n_words`` (before) and ``n_removed``.

    A word is a run of anything but blanks, tabs and line ends. A word is removed when a
    window of ``window`` words that covers it also starts in a document with a smaller id.
    A removed word takes the white space after it along; the rest of the text stays as it is.

    Null and empty texts have no words and stay as they are. A row with a null id is neither
    cut nor compared. Rows with equal ids are the same document: they do not cut each other,
    and each is judged by its own text. Other columns pass through; input columns named like the
    two counts are replaced by them. An empty table gives an empty result.
    """
    if not 1 <= k <= window:
        raise ValueError("k must be from 1 to window")
    new = ["n_words", "n_removed"]
    keep = [c for c in docs.columns if c not in new]
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep if c != text_col]).alias("other"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    ).withColumn("text_hash", F.xxhash64("text"))
    scanned = base.select("id", "text_hash", "text").where("id is not null")
    runs = materialise(
        scanned.mapInArrow(partial(_find_runs, window=window, k=k), _RUNS), "substring-runs"
    )
    repeated = materialise(
        runs.groupBy("minimiser")
        .agg(
            F.count("*").alias("n"),
            F.min("id").alias("lo"),
            F.max("id").alias("hi"),
            F.sum(F.col("windows") + (window - 1)).alias("words"),
        )
        .where("lo < hi")
        .select("minimiser", "n", "words"),
        "substring-repeated",
    )
    total = repeated.agg(F.sum("words")).first()[0] or 0
    buckets = max(64, -(-total // bucket_words))
    salts = F.ceil(F.col("n") / hot)
    salt = F.pmod(F.xxhash64("id", "text_hash"), salts)
    routed = (
        runs.join(repeated.select("minimiser", "n"), "minimiser")
        .select(
            "id",
            "text_hash",
            F.struct(
                "start",
                "windows",
                F.pmod(F.xxhash64("minimiser", salt), F.lit(buckets)).alias("bucket"),
                (salts > 1).alias("salted"),
            ).alias("run"),
        )
        .groupBy("id", "text_hash")
        .agg(F.sort_array(F.collect_set("run")).alias("runs"))
    )
    # Both joins below use this one exchange of the texts, so both keep all its columns.
    dealt = base.repartition(F.col("id"), F.col("text_hash"))
    travelling = dealt.join(routed, ["id", "text_hash"], "left").mapInArrow(
        partial(_pack, window=window),
        "bucket long, id long, text_hash long, start int, salted boolean, packed string",
    )

    def sort_bucket(table: pa.Table) -> pa.Table:
        return _sort_windows(table, window)

    found = travelling.groupBy("bucket").applyInArrow(sort_bucket, _FOUND)
    first = F.min("id").over(Window.partitionBy("a", "b"))
    spans = (
        found.withColumn("first", first)
        .where("decided or id > first")
        .groupBy("id", "text_hash")
        .agg(F.sort_array(F.collect_set(F.struct("start", "windows"))).alias("spans"))
    )
    schema = base.select("other", "text").schema.add("n_words", "long").add("n_removed", "long")
    cut = dealt.join(spans, ["id", "text_hash"], "left").mapInArrow(
        partial(_cut, window=window), schema
    )
    columns = [
        F.col("text").alias(c) if c == text_col else F.col(f"other.`{c}`") for c in keep
    ]
    return cut.select(*columns, *new)


def _runs(words, window: int, k: int) -> tuple[np.ndarray, ...]:
    """Row, first window, number of windows and minimiser of each run in a chunk."""
    least = sliding_min(grams(words.digests(), k), window - k + 1)
    count = words.count()
    per_row = np.maximum(count - window + 1, 0)
    rows = np.repeat(np.arange(len(count)), per_row)
    if not len(rows):
        return (rows, rows, rows, np.zeros(0, U64))
    skip = np.cumsum(per_row) - per_row
    within = np.arange(len(rows)) - skip[rows]
    least = least[words.first[rows] + within]
    new = np.ones(len(rows), bool)
    new[1:] = (least[1:] != least[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    return rows[at], within[at], np.diff(np.append(at, len(rows))), least[at]


def _find_runs(batches: Iterator[pa.RecordBatch], window: int, k: int):
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        text_hash = batch.column("text_hash").to_numpy(zero_copy_only=False)
        for words in chunks(text_column(batch, "text")):
            rows, start, n, least = _runs(words, window, k)
            at = rows + words.lo
            yield pa.RecordBatch.from_arrays(
                [
                    int64(least),
                    pa.array(ids[at]),
                    pa.array(text_hash[at]),
                    pa.array(start.astype(np.int32)),
                    pa.array(n.astype(np.int32)),
                ],
                ["minimiser", "id", "text_hash", "start", "windows"],
            )


def _pack(batches: Iterator[pa.RecordBatch], window: int):
    """Each run as one string: its words, joined by one blank."""
    names = ["bucket", "id", "text_hash", "start", "salted", "packed"]
    for batch in batches:
        ids, hashes = batch.column("id").to_pylist(), batch.column("text_hash").to_pylist()
        texts, runs = batch.column("text"), batch.column("runs")
        out: list[list] = [[] for _ in names]
        size = 0
        for i in range(len(batch)):
            if not runs[i].is_valid or ids[i] is None:
                continue
            words = texts[i].as_py().encode().split()
            for run in runs[i].as_py():
                piece = b" ".join(words[run["start"] : run["start"] + run["windows"] + window - 1])
                size += len(piece)
                row = (run["bucket"], ids[i], hashes[i], run["start"], run["salted"], piece)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            if size > 4 << 20:
                yield _packed(out, names)
                out, size = [[] for _ in names], 0
        if out[0]:
            yield _packed(out, names)


def _packed(out: list[list], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
    columns = [pa.array(v, t) for v, t in zip(out, kinds, strict=True)]
    columns[-1] = columns[-1].cast(pa.string())
    return pa.RecordBatch.from_arrays(columns, names)


def _sort_windows(table: pa.Table, window: int) -> pa.Table:
    """Sort a bucket's windows; say which start in a document that is not their first."""
    ids = table.column("id").to_numpy()
    order = np.argsort(ids, kind="stable")
    table = table.take(pa.array(order))
    ids = ids[order]
    salted = table.column("salted").to_numpy()
    a, b, run, at = [], [], [], []
    for words in chunks(text_column(table, "packed")):
        h = words.digests()
        one, two = grams(h, window), grams(h, window, 0xA0761D6478BD642F)
        per_row = words.count() - window + 1
        rows = np.repeat(np.arange(len(per_row)), per_row)
        within = np.arange(len(rows)) - (np.cumsum(per_row) - per_row)[rows]
        place = words.first[rows] + within
        a.append(one[place])
        b.append(two[place])
        run.append((rows + words.lo).astype(np.int32))
        at.append(within.astype(np.int32))
    a, b, run, at = map(np.concatenate, (a, b, run, at))
    order = np.argsort(a, kind="stable")
    sa, sb = a[order], b[order]
    if np.any((sa[1:] == sa[:-1]) & (sb[1:] != sb[:-1])):
        order = np.lexsort((np.arange(len(a)), b, a))
        sa, sb = a[order], b[order]
    new = np.ones(len(sa), bool)
    new[1:] = (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])
    doc = ids[run[order]]
    later = doc > doc[new][np.cumsum(new) - 1]  # the runs came in the order of their ids
    copied = np.zeros(len(a), bool)
    copied[order] = later
    # Neighbouring copied windows of a run are one span.
    step = np.zeros(len(a), bool)
    step[1:] = copied[:-1] & (run[1:] == run[:-1])
    begin = np.flatnonzero(copied & ~step)
    follow = np.zeros(len(a), bool)
    follow[:-1] = copied[1:] & (run[1:] == run[:-1])
    stop = np.flatnonzero(copied & ~follow)
    # Firsts of a dealt minimiser are settled across its buckets.
    open_ = np.zeros(len(a), bool)
    open_[order] = ~later
    open_ = np.flatnonzero(open_ & salted[run])
    rows = np.concatenate([begin, open_])
    n = np.concatenate([stop - begin + 1, np.ones(len(open_), np.int64)])
    start = table.column("start").to_numpy()[run[rows]] + at[rows]
    decided = np.arange(len(rows)) < len(begin)
    doc = ids[run[rows]]
    # Decided spans need no partner: their key only has to spread them.
    a = np.where(decided, doc.view(U64), a[rows])
    b = np.where(decided, start.astype(U64), b[rows])
    return pa.table(
        {
            "a": int64(a),
            "b": int64(b),
            "id": pa.array(doc),
            "text_hash": pa.array(table.column("text_hash").to_numpy()[run[rows]]),
            "start": pa.array(start.astype(np.int32)),
            "windows": pa.array(n.astype(np.int32)),
            "decided": pa.array(decided),
        }
    )


def _cut(batches: Iterator[pa.RecordBatch], window: int):
    for batch in batches:
        texts, spans = text_column(batch, "text"), batch.column("spans")
        cut = pc.is_valid(spans).to_numpy(zero_copy_only=False)
        counts, removed, out = [], np.zeros(len(batch), np.int64), texts
        new: dict[int, bytes] = {}
        for words in chunks(texts):
            counts.append(words.count())
            for i in np.flatnonzero(cut[words.lo : words.hi]).tolist():
                lo, hi = words.first[i], words.first[i + 1]
                keep = np.ones(hi - lo, bool)
                for span in spans[words.lo + i].as_py():
                    keep[span["start"] : span["start"] + span["windows"] + window - 1] = False
                removed[words.lo + i] = len(keep) - int(keep.sum())
                new[words.lo + i] = _kept(words, i, keep)
        if new:
            values = [new[i] if i in new else t.as_py() for i, t in enumerate(texts)]
            out = pa.array([v.encode() if isinstance(v, str) else v for v in values], pa.binary())
            out = out.cast(pa.string())
        n_words = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("other"), out, pa.array(n_words.astype(np.int64)), pa.array(removed)],
            ["other", "text", "n_words", "n_removed"],
        )


def _kept(words, i: int, keep: np.ndarray) -> bytes:
    """Text ``i`` of a chunk without the words marked False, nor the white space after them."""
    lo, hi = words.first[i], words.first[i + 1]
    after = np.append(words.start[lo + 1 : hi], words.offsets[i + 1])
    edge = np.diff(np.concatenate([[False], keep, [False]]).astype(np.int8))
    begin, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    pieces = [
        words.data[words.start[lo + x] : after[y - 1]].tobytes()
        for x, y in zip(begin, stop, strict=True)
    ]
    return b"".join(pieces)
