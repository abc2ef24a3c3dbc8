"""Quality classifier: a document's own evidence under hierarchical empirical Bayes site priors.

1. Two logistic heads (good quality, toxic) are fitted on a bounded sample of labelled
   documents: style counts of the bytes and words, and presence of hashed words.
2. One scan gives every document its evidence, the log likelihood ratio of each head. Grouped
   aggregation sums expected labels by path and host; only one row a site and task is shuffled.
3. Host rates shrink towards the global rate, path rates towards their host's. The strength of
   each shrinkage is the Beta prior fitted by moments to the spread of the rates, so a site
   with few documents takes its parent's rate.
4. A document's evidence is added to the log odds of its path. Texts are not shuffled unless the
   table of sites is too large to be broadcast by size. Where texts are not asked for, the evidence is
   written by the first scan, beside the columns that are; otherwise a second scan gives it
   again, so that no text is written once more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from areaneed.llm.words import LOWER, U64, Words, _words, chunks, text_column
from areaneed.sources.scratch import materialise

HEADS = ("quality", "toxic")
_BITS = 14
_LETTERS = LOWER.copy()
_LETTERS[[i for i in range(128) if not chr(i).isalnum()]] = 0x20


def _among(text: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(text.encode())] = True
    return table


_CLASSES = [
    _among("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    _among("0123456789"),
    _among(".,;:'\"()-"),
    _among("!?"),
    _among("#$%&*@^~+=<>"),
    _among("|{}[]\\/_"),
    _among("\n"),
]


@dataclass
class Model:
    """Weights of the heads; ``base`` holds the log odds of the sample they were fitted on."""

    mean: np.ndarray
    scale: np.ndarray
    style: np.ndarray
    words: np.ndarray
    bias: np.ndarray
    base: np.ndarray

    def evidence(self, style: np.ndarray, rows: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """Log likelihood ratios by row and head."""
        logit = (style - self.mean) / self.scale @ self.style + self.bias - self.base
        for j in range(len(HEADS)):
            logit[:, j] += np.bincount(rows, self.words[buckets, j], len(style))
        return logit


def features(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Style of each row of a chunk; row and bucket of each hashed word; words of each row."""
    n, data, at = words.hi - words.lo, words.data, words.offsets
    size = np.maximum(1, np.diff(at)).astype(float)
    style = []
    for table in _CLASSES:
        total = np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
        style.append((total[at[1:]] - total[at[:-1]]) / size)
    count = words.count()
    some = np.maximum(1, count).astype(float)
    row, h = words.row_of_word(), words.hashes(LOWER)
    again = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    style.append(np.bincount(row[1:][again], minlength=n) / some)
    style.append(np.log1p(count))
    style.append((size - count) / some / 10)
    plain = _words(words.lo, words.hi, _LETTERS[data], at)
    bucket = (plain.hashes() >> U64(64 - _BITS)).astype(np.int64)
    pairs = np.unique((plain.row_of_word().astype(np.int64) << _BITS) | bucket)
    rows, buckets = pairs >> _BITS, pairs & ((1 << _BITS) - 1)
    style.append(np.bincount(rows, minlength=n) / some)
    # Small shares matter as much as large ones.
    values = np.array(style).T
    return np.hstack([values, np.sqrt(np.abs(values))]), rows, buckets, count


def fit(style: np.ndarray, rows: np.ndarray, buckets: np.ndarray, labels: np.ndarray) -> Model:
    """Both heads by gradient descent with momentum and an L2 penalty; labels 0 or 1, NaN: none."""
    n, d = style.shape
    mean, scale = style.mean(axis=0), style.std(axis=0) + 1e-6
    x = (style - mean) / scale
    seen = np.bincount(buckets, minlength=1 << _BITS)
    often = seen[buckets] >= 5
    rows, buckets = rows[often], buckets[often]
    w, words = np.zeros((d, len(HEADS))), np.zeros((1 << _BITS, len(HEADS)))
    bias, base = np.zeros(len(HEADS)), np.zeros(len(HEADS))
    for j in range(len(HEADS)):
        known = ~np.isnan(labels[:, j])
        y = np.where(known, labels[:, j], 0)
        rate = y.sum() / max(1, known.sum())
        if not 0 < rate < 1:
            continue
        base[j] = bias[j] = np.log(rate / (1 - rate))
        v, u, b = np.zeros(d), np.zeros(1 << _BITS), bias[j]
        # Adam's steps fit features of very different frequency.
        state = [(np.zeros(d), np.zeros(d)), (np.zeros(1 << _BITS), np.zeros(1 << _BITS))]
        state.append((np.zeros(1), np.zeros(1)))
        for step in range(1, 201):
            z = x @ v + np.bincount(rows, u[buckets], n) + b
            error = np.where(known, 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y, 0) / known.sum()
            slope = [
                x.T @ error + 1e-4 * v,
                np.bincount(buckets, error[rows], 1 << _BITS) + 3e-4 * u,
                np.array([error.sum()]),
            ]
            moves = []
            for g, (m, s) in zip(slope, state, strict=True):
                m *= 0.9
                m += 0.1 * g
                s *= 0.999
                s += 0.001 * g * g
                moves.append(
                    0.05 * m / (1 - 0.9**step) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
                )
            v, u, b = v - moves[0], u - moves[1], b - moves[2][0]
        w[:, j], words[:, j], bias[j] = v, u, b
    return Model(mean, scale, w, words, bias, base)


def _features(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for words in chunks(text_column(batch, "text")):
            style, rows, buckets, _ = features(words)
            edge = np.searchsorted(rows, np.arange(len(style) + 1)).astype(np.int32)
            part = batch.slice(words.lo, len(style))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(style.tolist(), pa.list_(pa.float64())),
                    pa.ListArray.from_arrays(pa.array(edge), pa.array(buckets.astype(np.int32))),
                    part.column("quality"),
                    part.column("toxic"),
                ],
                ["style", "buckets", "quality", "toxic"],
            )


def _evidence(batches: Iterator[pa.RecordBatch], model: Model, text_col: str, within: str = ""):
    """``within``: the struct column that holds the text; a text of its own is not passed on."""
    for batch in batches:
        found = np.zeros((len(batch), len(HEADS)))
        text = batch.column(within).field(text_col) if within else text_column(batch, text_col)
        for words in chunks(text):
            style, rows, buckets, count = features(words)
            own = np.clip(model.evidence(style, rows, buckets), -30, 30)
            found[words.lo : words.hi] = np.where(count[:, None] > 0, own, 0)
        passed = [c for c in batch.schema.names if within or c != text_col]
        columns = [batch.column(c) for c in passed]
        columns += [pa.array(found[:, j]) for j in range(len(HEADS))]
        yield pa.RecordBatch.from_arrays(columns, [*passed, *[f"{x}_evidence" for x in HEADS]])


def fitted(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int, seed: int = 0
) -> Model:
    """The model of at most ``sample`` labelled documents, taken by a hash of their ids."""
    known = labels.select(
        F.col(f"`{id_col}`").alias("id"), *[F.col(x).cast("double").alias(x) for x in HEADS]
    ).where("id is not null")
    known = known.orderBy(F.xxhash64("id", F.lit(seed)), "id", *HEADS).limit(sample)
    # At most ``sample`` rows of three numbers.
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")
    ).join(F.broadcast(known), "id")
    rows = rows.orderBy(F.xxhash64("id", F.lit(seed)), "id", F.sha2("text", 256)).limit(sample)
    table = rows.select("text", *HEADS).mapInArrow(
        _features, "style array<double>, buckets array<int>, quality double, toxic double"
    ).toArrow()
    n = len(table)
    buckets = table.column("buckets").combine_chunks()
    size = np.diff(buckets.offsets.to_numpy()) if n else np.zeros(0, int)
    y = [table.column(x).to_pandas().to_numpy(float, na_value=np.nan) for x in HEADS]
    width = 2 * (len(_CLASSES) + 4)
    style = table.column("style").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    if not n:
        zero = np.zeros(len(HEADS))
        return Model(
            np.zeros(width), np.ones(width), np.zeros((width, len(HEADS))),
            np.zeros((1 << _BITS, len(HEADS))), zero, zero,
        )
    return fit(
        style.reshape(n, width),
        np.repeat(np.arange(n), size),
        buckets.flatten().to_numpy().astype(np.int64),
        np.array(y).T,
    )


def logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def _strength(rows: int, sites: int, mean: float, spread: float) -> float:
    """Pseudo-documents of a Beta prior whose rates vary as the sites do beyond chance."""
    chance = mean * (1 - mean)
    between = spread / max(1, rows) - chance * max(0, sites - 1) / max(1, rows)
    return float(np.clip(chance / between - 1 if between > 0 else 1e4, 1, 1e4))


def site_posteriors(evidence: DataFrame, global_rates: dict[str, float]) -> DataFrame:
    """(host, path, ``<head>_rate``): rates of paths, shrunk to their host and the global rate.

    ``evidence``: host, path and ``<head>_evidence`` of every document. A document's expected label is
    the sigmoid of its evidence and the global log odds of the head.
    """
    expected = [
        F.sum(sigmoid(F.col(f"{x}_evidence") + logit(F.lit(global_rates[x])))).alias(x)
        for x in HEADS
    ]
    paths = evidence.groupBy("host", "path").agg(F.count("*").alias("n"), *expected)
    paths = materialise(paths, "site-counts")
    hosts = paths.groupBy("host").agg(
        F.sum("n").alias("host_n"), *[F.sum(x).alias(f"host_{x}") for x in HEADS]
    )
    total = hosts.agg(
        F.sum("host_n").alias("n"),
        F.count("*").alias("sites"),
        *[F.sum(f"host_{x}").alias(x) for x in HEADS],
    ).first()
    n = total["n"] or 0
    mean = {x: (total[x] or 0) / n if n else global_rates[x] for x in HEADS}
    both = paths.alias("p").join(
        hosts.alias("h"), F.col("p.host").eqNullSafe(F.col("h.host"))
    ).select("p.*", "host_n", *[f"host_{x}" for x in HEADS])
    off = {x: F.col(x) / F.col("n") - F.col(f"host_{x}") / F.col("host_n") for x in HEADS}
    within = both.agg(
        F.count("*").alias("sites"), *[F.sum(F.col("n") * off[x] ** 2).alias(x) for x in HEADS]
    ).first()
    gap = {x: F.col(f"host_{x}") / F.col("host_n") - mean[x] for x in HEADS}
    among = hosts.agg(*[F.sum(F.col("host_n") * gap[x] ** 2).alias(x) for x in HEADS]).first()
    out = []
    for x in HEADS:
        k_host = _strength(n, total["sites"], mean[x], among[x] or 0)
        k_path = _strength(n, within["sites"] - total["sites"] + 1, mean[x], within[x] or 0)
        host = (F.col(f"host_{x}") + k_host * mean[x]) / (F.col("host_n") + k_host)
        out.append(((F.col(x) + k_path * host) / (F.col("n") + k_path)).alias(f"{x}_rate"))
    return materialise(both.select("host", "path", *out), "site-rates")


def classify(
    docs: DataFrame,
    labels: DataFrame,
    host: Column,
    path: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = 8_000,
    least_quality: float = 0.5,
    most_toxic: float = 0.5,
    columns: list[str] | None = None,
) -> DataFrame:
    """``docs`` (or its ``columns``, one at least) plus ``quality``, ``toxicity`` (posterior probabilities) and ``keep``.

    ``labels``: the id, ``quality`` and ``toxic`` (0 or 1, null: not known) of some documents; at most
    ``sample`` of them, taken by a hash of the id, fit the heads. All else covers all rows. ``keep``
    is false below ``least_quality`` or from ``most_toxic`` on.

    Null and empty texts have no evidence: their site's rates decide. A null host or path is a
    site like any other. Rows that repeat an id or a text are judged and counted one by one;
    null ids are never labelled. A head without labels of both kinds has no evidence and keeps all
    rows. Empty tables give an empty result; without labels every row is kept. Input
    columns named like the added ones are replaced; all others pass through.
    """
    new = ["quality", "toxicity", "keep"]
    if text_col in new:
        raise ValueError(f"the text column cannot be named {text_col}")
    keep = [c for c in (docs.columns if columns is None else columns) if c not in new]
    if not keep:
        raise ValueError("no column of the documents is left")
    model = fitted(docs, labels, id_col, text_col, sample)
    scored = [StructField(f"{x}_evidence", DoubleType()) for x in HEADS]
    text = F.col(f"`{text_col}`").cast("string").alias("text")
    site = [host.cast("string").alias("host"), path.cast("string").alias("path")]
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    carried = site if text_col in keep else [row, *site]
    thin = docs.select(*carried, text)
    add = partial(_evidence, model=model, text_col="text")
    evidence = thin.mapInArrow(add, StructType([*thin.schema.fields[:-1], *scored]))
    if text_col not in keep:
        evidence = materialise(evidence, "evidence")
    neutral = {"quality": 1 - 1e-6, "toxic": 1e-6}
    fitted_ = {x: bool(np.any(model.style[:, j])) for j, x in enumerate(HEADS)}
    rates = {
        x: 1 / (1 + np.exp(-model.base[j])) if fitted_[x] else neutral[x]
        for j, x in enumerate(HEADS)
    }
    sites = site_posteriors(evidence, {x: float(r) for x, r in rates.items()})
    if text_col in keep:
        whole = docs.select(row, *site)
        add = partial(_evidence, model=model, text_col=text_col, within="row")
        whole = whole.mapInArrow(add, StructType([*whole.schema.fields, *scored]))
    else:
        whole = evidence
    # Every site of the documents has a row.
    found = whole.alias("d").join(
        sites.alias("s"),
        F.col("d.host").eqNullSafe(F.col("s.host")) & F.col("d.path").eqNullSafe(F.col("s.path")),
    )
    good = sigmoid(F.col("quality_evidence") + logit(F.col("quality_rate")))
    bad = sigmoid(F.col("toxic_evidence") + logit(F.col("toxic_rate")))
    return found.select(
        "d.row.*",
        good.alias("quality"),
        bad.alias("toxicity"),
        ((good >= least_quality) & (bad < most_toxic)).alias("keep"),
    )
