"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from areaneed.llm.ann import tree_neighbours
from areaneed.llm.decontam import decontaminate
from areaneed.llm.jaccard import jaccard_components
from areaneed.llm.licenses import scan_licenses
from areaneed.llm.packing import harmonic_pack
from areaneed.llm.quality import classify
from areaneed.llm.queries import tokenizer_path
from areaneed.llm.sharding import shuffle_shards
from areaneed.llm.substring import substring_dedup
from areaneed.llm.toolcalls import breaches, judged, link_tool_calls
from areaneed.llm.warc import read_archives, write_archives

LONG = " ".join(f"w{i}" for i in range(60_000))
CASES = [
    (1, "one two three four five six seven eight nine ten eleven twelve"),
    (2, "one two three four five six seven eight nine ten eleven twelve"),
    (2, "one two three four five six seven eight nine ten eleven twelve"),
    (3, None),
    (4, ""),
    (5, LONG),
    (6, LONG),
    (None, "a text of a row that has no id"),
    (7, " \n\t "),
]
#: Names that operators add themselves.
EXTRA = ["n_words", "n", "row", "id", "w", "h", "fp", "keep", "shard", "bucket", "r", "host", "path"]


@pytest.fixture
def docs(spark):
    df = spark.createDataFrame(CASES, "doc_id long, text string")
    for name in EXTRA:
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.fixture
def items(spark):
    return spark.createDataFrame(
        [("a", "Four FIVE six seven eight nine ten eleven twelve thirteen"),
         ("b", "one two three four five six seven eight nine ten"),
         ("c", None), ("d", ""), ("e", "w7 w8")],
        "item_id string, text string",
    )


LABELS = "doc_id long, quality int, toxic int"


def operators(spark, items):
    none = spark.createDataFrame([], LABELS)
    return {
        "quality": lambda d: classify(d, none, F.lit(None), F.lit("p")),
        "substring": lambda d: substring_dedup(d, window=50),
        "jaccard": jaccard_components,
        "decontam": lambda d: decontaminate(d, items),
        "licenses": lambda d: scan_licenses(d, F.lit("a/b")),
        "sharding": lambda d: shuffle_shards(d, shards=3),
    }


NAMES = ["quality", "substring", "jaccard", "decontam", "licenses", "sharding"]


@pytest.mark.parametrize("name", NAMES)
def test_a_row_for_each_row(spark, docs, items, name):
    out = operators(spark, items)[name](docs).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(i) for i, _ in CASES)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, docs, items, name):
    assert operators(spark, items)[name](docs.limit(0)).count() == 0


def test_extra_columns_pass_through(spark, docs, items):
    for name in ("quality", "substring", "decontam", "sharding"):
        out = operators(spark, items)[name](docs).first()
        assert out["host"] == out["id"] == "x", name


def test_without_labels_all_stay(spark, docs, items):
    assert {r["keep"] for r in operators(spark, items)["quality"](docs).collect()} == {True}


def test_decontamination_cases(spark, docs, items):
    hit = {r["doc_id"]: r for r in operators(spark, items)["decontam"](docs).collect()}
    assert (hit[1]["n_hit"], hit[1]["items"]) == (10, ["b"])
    assert (hit[5]["n_hit"], hit[5]["items"]) == (2, ["e"])
    assert not hit[3]["contaminated"] and not hit[4]["contaminated"]
    clean = decontaminate(docs, items.limit(0)).select("contaminated").distinct().collect()
    assert [r[0] for r in clean] == [False]


def test_jaccard_cases(spark, docs):
    out = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_components(docs).collect()}
    assert (2, 8, 1) in out and (6, 59_996, 5) in out
    assert (3, 0, 3) in out and (7, 0, 7) in out and (None, 5, None) in out


def test_packing_cases(spark, docs):
    rows = harmonic_pack(docs, tokenizer_path(), end_id=2).collect()
    assert {r["doc_id"] for r in rows} == {i for i, _ in CASES}
    assert [r["length"] for r in rows if r["doc_id"] == 3] == [1]
    assert harmonic_pack(docs.limit(0), tokenizer_path(), end_id=2).count() == 0


def test_archives(spark):
    big = "x" * 150
    pages = [(3, "http://b\r\n", big), (1, None, big), (2, "u", ""), (4, "u", None), (None, "u", big)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("path", F.lit(1))
    out = {r["page_id"]: r for r in read_archives(write_archives(df)).collect()}
    assert out[3]["record_type"] == "revisit" and out[3]["refers_to"] == 1
    assert out[3]["payload_digest"] == hashlib.sha256(big.encode()).hexdigest()
    assert bytes(out[1]["payload"]).decode() == big
    assert {out[k]["record_type"] for k in (1, 2, 4, None)} == {"response"}
    assert read_archives(write_archives(df.limit(0))).count() == 0


def test_neighbours_cases(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]),
            (6, [float("nan"), 1.0]), (7, [None, 1.0]), (8, [1.0]), (20, [1.0, 0.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1))
    out = tree_neighbours(df, F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in out] == [(1, 1, 1.0), (2, 2, 1.0), (3, 3, 0.0)]
    assert tree_neighbours(df.limit(0), F.lit(True)).count() == 0


def test_schema_breaches():
    schema = {"type": "object", "required": ["a"], "additionalProperties": False,
              "properties": {"a": {"type": "integer", "minimum": 1}, "b": {"enum": [1, "x"]}}}
    assert breaches({"a": 1, "b": "x"}, schema) == []
    assert breaches({"a": True, "b": True, "c": 0}, schema) == ["$.c: unknown", "$.a: not integer", "$.b: not in enum"]
    assert judged("t", '{"b": 1.0, "a": NaN}', {"t": {}}) == (None, ["$: not JSON"])
    assert judged("t", '{"b":1, "a":"é"}', {"t": {}}) == ('{"a":"\\u00e9","b":1}', [])
    assert judged("t", "[" * 100_000, {"t": {}})[1] == ["$: not JSON"]


def test_tool_call_cases(spark):
    calls = spark.createDataFrame(
        [("c", "a", "t", "{}", None, 0), ("c", "b", "t", "{}", "a", 0), ("c", "x", "t", "{}", "y", 0),
         ("c", "y", "t", "{}", "x", 0), ("c", "z", "t", None, "z", 0), ("c", "m", "u", "{}", "gone", 0),
         ("c", "b", "t", "{}", "a", 0), ("d", None, "t", "{}", None, 0), (None, "a", "t", "{}", None, 0)],
        "conv_id string, call_id string, name string, arguments string, after string, rank int",
    )
    results = spark.createDataFrame(
        [("c", "a", "2"), ("c", "a", "1"), ("c", "o", None), ("d", None, "r")],
        "conv_id string, call_id string, content string",
    )
    rows = link_tool_calls(calls, results, {"t": {"type": "object"}}).collect()
    own = {(r["conv_id"], r["call_id"], r["status"]): r for r in rows}
    assert len(rows) == 11
    assert own["c", "a", "linked"]["n_results"] == 2
    assert '"result":"1"' in own["c", "a", "linked"]["json"]
    assert own["c", "b", "no result"]["depth"] == 1
    assert [own["c", k, "no result"]["depth"] for k in "xyz"] == [None] * 3
    assert own["c", "m", "no result"]["errors"] == ["$: unknown tool"]
    assert ("c", "o", "orphan result") in own and ("d", None, "orphan result") in own
    places = sorted(r["position"] for r in rows if r["conv_id"] == "c")
    assert places == list(range(8))
    assert link_tool_calls(calls.limit(0), results.limit(0), {}).count() == 0


def thue_morse(a: str, b: str, length: int = 2048) -> tuple[str, str]:
    """Two words with the same sums of powers: any polynomial hash modulo 2^64 is the same."""
    bits = [i.bit_count() & 1 for i in range(length)]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)


def test_words_with_equal_polynomials_are_different_words(spark):
    x, y = thue_morse("a", "b")
    around = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join([x, *around])), (2, " ".join([y, *around])), (3, x), (4, y), (5, x.upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cut = {r["doc_id"]: r for r in substring_dedup(docs, window=50).collect()}
    assert (cut[2]["n_words"], cut[2]["n_removed"]) == (61, 60) and cut[2]["text"].strip() == y
    out = {r["doc_id"]: r["component_id"] for r in jaccard_components(docs).collect()}
    assert out == {1: 1, 2: 1, 3: 3, 4: 4, 5: 3}
    packed = {r["doc_id"]: bytes(r["ids"]) for r in harmonic_pack(docs, tokenizer_path(), end_id=2).collect()}
    assert packed[3] != packed[4]


def test_short_words_are_told_apart_exactly():
    import pyarrow as pa

    from areaneed.llm.words import LOWER, chunks

    texts = ["a a\x00 \x00a A aaaaaaa aaaaaaaa aaaaaaA aaaaaaaA", "a", "aaaaaaaa " * 3]
    (words,) = chunks(pa.array(texts))
    one, two = words.digests(), words.digests(LOWER)
    assert len(set(one[:8].tolist())) == 8 and one[8] == one[0] and set(one[9:]) == {one[5]}
    assert two[3] == two[0] and two[6] == two[4] and two[7] == two[5]


def test_decontamination_finds_capital_sigma_between_letters(spark):
    text = "ΤΟ Δ.Σ. ΤΗΣ ΕΤΑΙΡΙΑΣ ΑΣ.Ε Σ ΑΣ'Σ one TWO three ΣΑΣ Kelvin İx four five six seven"
    items = spark.createDataFrame([("g", text), ("s", "ΑΣ Ε")], "item_id string, text string")
    rows = [(1, f"before it {text} after"), (2, text.lower()), (3, "x ΑΣ.Ε y"), (4, "ας ε")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in decontaminate(docs, items).collect()}
    assert found[1]["n_hit"] == found[1]["n_words"] - 3 and found[1]["items"] == ["g", "s"]
    assert (found[3]["n_hit"], found[3]["items"]) == (2, ["s"])
    assert not found[4]["contaminated"]


@pytest.mark.parametrize("similarity", [(1, 2), (3, 4), (1, 1)])
def test_jaccard_of_large_groups_beside_all_pairs(spark, similarity):
    import random

    random.seed(3)
    p, q = similarity
    common = [f"c{i}" for i in range(100)]
    rows = []
    for i in range(120):
        own = random.sample(common, random.randrange(40, 100)) + [f"x{i}_{j}" for j in range(random.randrange(30))]
        rows.append((i, " ".join(own)))
    rows += [(200, " ".join(common)), (201, " ".join(common[:50])), (202, " ".join([*common, *"abc"]))]
    sets = {i: frozenset(t.split()) for i, t in rows}
    least = {i: i for i in sets}
    for _ in sets:
        for i, a in sets.items():
            for j, b in sets.items():
                if q * len(a & b) >= p * len(a | b):
                    least[i] = least[j] = min(least[i], least[j])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for elements in (300, 2_000_000):
        out = jaccard_components(docs, n=1, similarity=similarity, group_elements=elements)
        assert {r["doc_id"]: r["component_id"] for r in out.collect()} == least


def test_neighbours_of_clusters_and_single_outliers(spark):
    """Every query finds 20, and recall holds for the worst tenth of the queries too."""
    import numpy as np

    rng = np.random.default_rng(1)
    centres = 10 * rng.normal(size=(60, 16))
    x = np.concatenate([np.repeat(centres, 80, axis=0) + 0.3 * rng.normal(size=(4800, 16)),
                        300 * rng.normal(size=(40, 16)), np.repeat(-30 * centres[:4], 60, axis=0)])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    found = {}
    is_query = (F.col("vec_id") % 20 == 0) | (F.col("vec_id") >= 4800)
    for r in tree_neighbours(df, is_query, leaf_vectors=40).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    ids, recall = np.arange(len(x)), []
    assert sorted(found) == [i for i in ids if i % 20 == 0 or i >= 4800]
    for q, own in found.items():
        own.sort()
        assert [r for r, _, _ in own] == list(range(1, 21)) and q not in [v for _, v, _ in own]
        scores = x @ x[q]
        order = [v for v in np.lexsort((ids, -scores)) if v != q][:20]
        recall.append(len({v for _, v, _ in own} & set(order)) / 20)
    recall.sort()
    assert np.mean(recall) >= 0.95 and np.mean(recall[: len(recall) // 10]) >= 0.9


def test_calls_with_several_predecessors_beside_plain_recursion(spark):
    import random

    random.seed(8)
    edges = {}
    for i in range(300):  # a graph without cycles, chains and joins mixed
        edges[f"n{i}"] = {f"n{j}" for j in random.sample(range(i), min(i, random.choice([0, 1, 1, 1, 2, 3])))}
    for i in range(50):
        edges[f"c{i}"] = {f"c{i - 1}"} if i else set()
    edges |= {"z1": {"z2", "n5"}, "z2": {"z3"}, "z3": {"z1"}, "b": {"z2"}, "b2": {"b", "n1"}, "g": {"gone", "n0"}}
    edges |= {"b0": {"z", "a"}, "a": set(), "z": {"a"}, "self": {"self"}}
    rows = [("c", k, "t", "{}", sorted(v) or None) for k, v in edges.items()]
    rows += [("c", "b0", "t", "{}", ["a"]), ("d", "n5", "t", "{}", ["n4", None])]
    calls = spark.createDataFrame(rows, "conv_id string, call_id string, name string, arguments string, after array<string>")
    results = spark.createDataFrame([], "conv_id string, call_id string, content string")
    found = link_tool_calls(calls, results, {"t": {}}).where("conv_id = 'c'").collect()
    known: dict = {}

    def depth(k, seen=()):
        if k in seen:
            return None
        if k not in known:
            below = [depth(x, (*seen, k)) for x in edges[k] if x in edges]
            known[k] = None if None in below else max((x + 1 for x in below), default=0)
        return known[k]

    on_cycle = {"z1", "z2", "z3", "b", "b2", "self"}
    for r in found:
        want = None if r["call_id"] in on_cycle else depth(r["call_id"])
        assert r["depth"] == want, r["call_id"]
    place = {r["call_id"]: r["position"] for r in found}
    assert all(place[a] < place[k] for k, v in edges.items() if k not in on_cycle for a in v if a in edges)


MIT = """MIT License

Copyright (c) 2020 John Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
"""
GPL_HEADER = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
import os
"""


def test_real_headers_and_licence_files_are_found(spark):
    rows = [
        (1, "a/LICENSE", MIT),
        (2, "a/x/code.py", "import os"),
        (3, "b/code.py", GPL_HEADER),
        (4, "b/long.py", "# tool.py Released under the MIT License. Copyright 2020 John Doe. All else."),
        (5, "b/wrapped.txt", "* This work is licensed under the GNU General\n * Public License, version 3.\n"),
        (6, "c/file.js", "/* Licensed under the Apache License, Version 2.0 (the \"License\");\n * you may not"
         " use this file except in compliance with the License. */"),
        (7, "d/lesser.c", GPL_HEADER.replace("General", "Lesser General")),
        (8, "e/none.txt", "She was licensed to drive, and the public was free to see the software museum."),
        (9, "f/mpl.rs", "// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0."),
        (10, "g/LICENSE", "GNU GENERAL PUBLIC LICENSE\n Version 2, June 1991\n\n Copyright (C) 1989, 1991"),
    ]
    rows += [(100 + i, f"t/{i}", f"plain prose number {i} the of a version software file use") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, p string, text string")
    found = {r["doc_id"]: r for r in scan_licenses(docs, F.col("p")).collect()}
    got = {i: (found[i]["license"], found[i]["found"]) for i in range(1, 11)}
    assert got == {
        1: ("MIT", "own"), 2: ("MIT", "inherited"), 3: ("GPL-3.0", "own"), 4: ("MIT", "own"),
        5: ("GPL-3.0", "own"), 6: ("Apache-2.0", "own"), 7: ("LGPL-3.0", "own"), 8: (None, "none"),
        9: ("MPL-2.0", "own"), 10: ("GPL-2.0", "own"),
    }
    assert {found[100 + i]["found"] for i in range(60)} == {"none"}


def test_copies_of_a_hot_group_grow_with_its_size(spark, monkeypatch):
    """Near copies of one text, in groups far larger than a task takes."""
    import random

    from areaneed.llm import jaccard

    routed, real = [], jaccard._routed

    def counted(base, searches, group_elements):
        routed.append(searches.count())
        return real(base, searches, group_elements)

    monkeypatch.setattr(jaccard, "_routed", counted)
    totals = []
    for copies in (100, 200, 400):
        random.seed(1)
        rows = []
        for i in range(copies):
            words = [f"c{j}" for j in range(200)]
            words[random.randrange(200)] = f"own{i}"
            rows.append((i, " ".join(words)))
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        routed.clear()
        out = jaccard_components(docs, n=5, group_elements=4000).collect()
        assert {r["component_id"] for r in out} == {0}
        totals.append(sum(routed))
    assert totals[0] >= 100 and totals[2] <= 2.5 * totals[1] <= 6.25 * totals[0]
    assert totals[2] <= 3 * 400 * 5
