"""License scan in DataFrame functions only: TF-IDF cosine to templates, then inheritance by path.

1. One scan counts in how many texts each word of the templates occurs.
2. A text reaches the least cosine with a template only if it has one of the template's heaviest
   words: the others alone are too short a vector (Cauchy-Schwarz). A second scan takes the texts
   that have one and compares, with all templates, their lines and the whole of a licence file; and
   with the template itself, the run of as many words as it has that puts the heavy word where the
   template has it. Runs ignore line ends, so wrapped headers and notices inside longer lines
   or licence texts are found. Each word outside all templates is a dimension of its own with the
   largest weight. Nothing is shuffled.
3. Licence files speak for their directory. Each directory is joined with its ancestors, and takes
   the deepest that has a licence; its documents without one inherit that. Only directories are
   gathered, however many documents one has.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaneed.sources.scratch import materialise

# Notices of well-known licences and sentences that only their texts have.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "under the terms of the GNU General Public License as published by the Free Software "
        "Foundation; either version 2 of the License",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "under the terms of the GNU General Public License as published by the Free Software "
        "Foundation, either version 3 of the License",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "under the terms of the GNU Lesser General Public License as published by the Free Software "
        "Foundation, either version 3 of the License",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Mozilla Public License Version 2.0 1. Definitions",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
}
_SPLIT = "[^a-z0-9]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> list[str]:
    return [w for w in re.split(_SPLIT, text.translate(str.maketrans(_UPPER, _LOWER))) if w]


def _numbers(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x
    )


def _heavy(weights: dict[str, float], least: float) -> set[str]:
    """The fewest heaviest words without which no vector reaches the cosine ``least``."""
    norm = math.sqrt(sum(v * v for v in weights.values()))
    found, rest = set(), sum(v * v for v in weights.values())
    for word in sorted(weights, key=lambda w: (-weights[w], w)):
        # A little early, so that rounding cannot lose a line.
        if math.sqrt(max(0.0, rest)) < 0.999 * least * norm:
            break
        found.add(word)
        rest -= weights[word] ** 2
    return found


def scan_licenses(
    docs: DataFrame,
    path: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, list[str]] | None = None,
    license_file: str = "LICENSE",
    least: float = 0.8,
) -> DataFrame:
    """One row per row of ``docs``: the id, ``path``, ``license``, ``score``, ``found`` and ``from_path``.

    ``found``: ``own`` (a line of the text, a run of words as long as a template and in line with one of
    its heavy words, or the whole of a licence file has at least the cosine ``least`` with a template), ``inherited`` (from the licence file ``from_path`` of the nearest
    directory above that has one) or ``none``. Of several the larger score counts (9 digits),
    then the smaller name of the licence; in a directory also the smaller path.

    Weights: tf * (ln((1 + texts) / (1 + texts with the word)) + 1), over all texts; words of
    A-Z, a-z and 0-9. Null and empty texts have no licence of their own but inherit. A row
    with a null path has no directory. Null and equal ids and equal paths are rows of their
    own. Other columns are not read. An empty table gives an empty result.
    """
    templates = TEMPLATES if templates is None else templates
    named = [(name, words(text)) for name in sorted(templates) for text in templates[name]]
    if not named or not all(own for _, own in named):
        raise ValueError("every template needs words")
    vocabulary = sorted({w for _, own in named for w in own})
    terms = F.array(*[F.lit(w) for w in vocabulary])
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    base = docs.select(
        F.col(f"`{id_col}`").alias("id"), path.cast("string").alias("path"), text.alias("text")
    )
    lower = F.translate("text", _UPPER, _LOWER)
    seen = base.select(F.array_intersect(F.split(lower, _SPLIT), terms).alias("w"))
    # One row a word of the templates, and one for the number of texts.
    counted = (
        seen.select(F.explode(F.concat("w", F.array(F.lit("")))).alias("w")).groupBy("w").count()
    )
    df = {r["w"]: r["count"] for r in counted.collect()}
    n = df.get("", 0)
    idf = {w: math.log((1 + n) / (1 + df.get(w, 0))) + 1 for w in vocabulary}
    other = math.log(1 + n) + 1
    weights = [{w: k * idf[w] for w, k in Counter(own).items()} for _, own in named]
    heavy = [_heavy(v, least) for v in weights]
    anchors = sorted(set().union(*heavy))
    pattern = "(?<![a-z0-9])(?:" + "|".join(anchors) + ")(?![a-z0-9])"

    is_file = F.element_at(F.split("path", "/"), -1) == license_file
    lines = F.split("lower", "[\\n\\r]+")
    lines = F.when(is_file, F.concat(lines, F.array("lower"))).otherwise(lines)

    vectors = F.array(*[_numbers([v.get(w, 0.0) for w in vocabulary]) for v in weights])
    sizes = _numbers([math.sqrt(sum(x * x for x in v.values())) for v in weights])
    names = F.array(*[F.lit(name) for name, _ in named])
    every = F.array(*[F.lit(t) for t in range(len(named))])
    # Where a heavy word stands in its templates: (template, words before it, words of all).
    place = F.create_map(
        *[
            x
            for anchor in anchors
            for x in (
                F.lit(anchor),
                F.array(
                    *[
                        F.struct(
                            F.lit(t).alias("t"),
                            F.lit(own.index(anchor)).alias("before"),
                            F.lit(len(own)).alias("length"),
                        )
                        for t, (_, own) in enumerate(named)
                        if anchor in heavy[t]
                    ]
                ),
            )
        ]
    )
    heavy_words = F.array(*[F.lit(x) for x in anchors])

    def terms_of(found: Column) -> Column:
        """The terms of some words, counted; ``found`` has the words and the templates to compare."""
        tf = F.transform(terms, lambda t: F.size(F.filter(found["w"], lambda w: w == t)))
        return F.struct(F.size(found["w"]).alias("n"), tf.alias("tf"), found["ts"].alias("ts"))

    def weighed(found: Column) -> Column:
        known = F.aggregate(found["tf"], F.lit(0), lambda total, x: total + x)
        own = F.zip_with(found["tf"], _numbers([idf[w] for w in vocabulary]), lambda x, y: x * y)
        rest = (found["n"] - known) * (other * other)
        return F.struct(own.alias("own"), rest.alias("rest"), found["ts"].alias("ts"))

    def scores(found: Column) -> Column:
        norm = F.sqrt(_dot(found["own"], found["own"]) + found["rest"])

        def score(t: Column) -> Column:
            cosine = _dot(found["own"], F.get(vectors, t)) / (norm * F.get(sizes, t))
            return F.struct(F.round(cosine, 9).alias("score"), F.get(names, t).alias("license"))

        return F.transform(found["ts"], score)

    def cut(line: Column) -> Column:
        return F.filter(F.split(line, _SPLIT), lambda w: w != "")

    def runs(w: Column) -> Column:
        """Runs of words of a text, by their templates."""
        at = F.filter(
            F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.array_contains(heavy_words, F.get(w, i))
        )
        begins = F.flatten(
            F.transform(
                at,
                lambda i: F.transform(
                    F.element_at(place, F.get(w, i)),
                    lambda p: F.struct(
                        F.greatest(F.lit(1), i - p["before"] + 1).alias("start"),
                        p["length"].alias("length"),
                        p["t"].alias("t"),
                    ),
                ),
            )
        )
        return F.transform(
            F.array_distinct(begins),
            lambda r: F.struct(
                F.slice(w, r["start"], r["length"]).alias("w"), F.array(r["t"]).alias("ts")
            ),
        )

    # Each step binds what the one before gave, so nothing is evaluated twice.
    has_one = F.col("lower").rlike(pattern)
    matching = F.filter(lines, lambda x: x.rlike(pattern))
    whole = F.transform(matching, lambda x: F.struct(cut(x).alias("w"), every.alias("ts")))
    inside = F.flatten(F.transform(F.array(cut(F.col("lower"))), runs))
    found = F.when(has_one, F.concat(whole, inside))
    found = F.transform(F.transform(F.transform(found, terms_of), weighed), scores)
    judged = base.select("id", "path", lower.alias("lower")).select(
        "id", "path", F.coalesce(F.flatten(found), F.array()).alias("scores")
    )
    judged = judged.select(
        "id",
        "path",
        F.aggregate(
            F.filter("scores", lambda s: s["score"] >= least),
            F.lit(None).cast("struct<score:double,license:string>"),
            lambda a, b: F.when(
                a.isNull()
                | (b["score"] > a["score"])
                | ((b["score"] == a["score"]) & (b["license"] < a["license"])),
                b,
            ).otherwise(a),
        ).alias("own"),
        F.regexp_replace("path", "/?[^/]*$", "").alias("dir"),
        F.coalesce(is_file, F.lit(False)).alias("is_file"),
    )
    judged = materialise(judged, "own-licences")
    speaking = (
        judged.where("is_file and own is not null")
        .groupBy("dir")
        .agg(
            F.min(
                F.struct(
                    (-F.col("own.score")).alias("minus"),
                    F.col("own.license").alias("license"),
                    "path",
                )
            ).alias("top")
        )
        .select(F.col("dir").alias("above"), "top")
    )
    parts = F.split("dir", "/")
    above = F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, 1, i), "/"),
    )
    chains = judged.where("dir is not null").select("dir").distinct().select(
        "dir", F.explode(F.array_distinct(above)).alias("above")
    )
    nearest = materialise(
        chains.join(speaking, "above")
        .groupBy("dir")
        .agg(F.max_by("top", F.length("above")).alias("top")),
        "directory-licences",
    )
    out = judged.join(nearest, "dir", "left")
    mine, theirs = F.col("own").isNotNull(), F.col("top").isNotNull()
    return out.select(
        F.col("id").alias(id_col),
        "path",
        F.coalesce("own.license", "top.license").alias("license"),
        F.coalesce(F.col("own.score"), -F.col("top.minus")).alias("score"),
        F.when(mine, "own").when(theirs, "inherited").otherwise("none").alias("found"),
        F.when(~mine, F.col("top.path")).alias("from_path"),
    )
