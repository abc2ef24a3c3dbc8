"""Registered queries beside their SQL, or beside a brute-force version."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from compare import duck_rows, spark_rows
from pyspark.sql import functions as F

import corpus_pipeline
from areaneed.llm import licenses
from areaneed.llm.queries import ORACLES, QUERIES, document_path, read
from areaneed.llm.quality import classify

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, sf_dir, con, name):
    assert spark_rows(QUERIES[name](spark, sf_dir)) == duck_rows(con, ORACLES[name])


def test_quality_on_held_out_labels(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    half = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    judged = classify(docs, half, F.col("source"), F.col("lang"))
    rest = labels.join(half, "doc_id", "left_anti").withColumnRenamed("quality", "good")
    rest = judged.join(rest, "doc_id").toPandas()
    clean = (rest["good"] == 1) & (rest["toxic"] == 0)
    assert rest["keep"][clean].mean() >= 0.95
    assert (~rest["keep"][rest["good"] == 0]).mean() >= 0.8
    assert (rest["keep"] == clean).mean() >= 0.75


def test_neighbours_recall(spark, sf_dir):
    table = read(spark, sf_dir, "embeddings").toPandas()
    ids, x = table["vec_id"].to_numpy(), np.array(table["embedding"].tolist(), float)
    found = defaultdict(list)
    for r in QUERIES["op3_neighbours"](spark, sf_dir).collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    queries = [i for i in ids if i % 20 == 0]
    assert sorted(found) == sorted(queries)
    place, hit = {v: i for i, v in enumerate(ids)}, 0
    for q in queries:
        own = sorted(found[q])
        assert [r for r, _, _ in own] == list(range(1, 21))
        scores = x @ x[place[q]]
        for _, v, s in own:
            assert v != q and abs(scores[place[v]] - s) < 1e-12
        assert own == sorted(own, key=lambda r: (-r[2], r[1]))
        order = [v for v in ids[np.lexsort((ids, -scores))] if v != q][:20]
        hit += len(set(order) & {v for _, v, _ in own})
    assert hit >= 0.9 * 20 * len(queries)


def test_packing_keeps_every_id(spark, sf_dir):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = {r["doc_id"]: r["text"] for r in read(spark, sf_dir, "documents").collect()}
    rows = QUERIES["op5_packing"](spark, sf_dir).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert by_doc.keys() == docs.keys()
    for doc_id, text in docs.items():
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert zlib.crc32(ids[r["start"] : at].tobytes()) == r["ids_crc32"]
        assert at == len(ids)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert padding <= 0.02 * sum(r["length"] for r in rows)


def _plain_json(x):
    """Canonical JSON written by hand."""
    if isinstance(x, dict):
        return "{" + ",".join(f"{_plain_json(k)}:{_plain_json(x[k])}" for k in sorted(x)) + "}"
    if isinstance(x, str):
        out = ""
        for unit in x.encode("utf-16-be").hex(" ", 2).split():
            c = chr(int(unit, 16))
            short = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}
            out += short.get(c) or (c if " " <= c <= "~" or c == "\x7f" else "\\u" + unit)
        return f'"{out}"'
    return "null" if x is None else str(x)


def test_tool_calls(spark, sf_dir):
    """Every turn of the table, beside plain Python that shares no code with the operator."""
    turns = [tuple(r) for r in read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows = QUERIES["op7_tool_calls"](spark, sf_dir).collect()
    found = {(r["conv_id"], r["call_id"], r["status"] != "orphan result"): r for r in rows}
    calls = {(str(c), t): x for c, t, role, x in turns if role == "assistant"}
    others = {(str(c), t - 1): x for c, t, role, x in turns if role != "assistant"}
    assert len(rows) == len(found) == len(calls) + len(others.keys() - calls.keys())
    assert len(turns) == len(calls) + len(others)

    def depth(conv, turn):
        before = [turn - 2] + ([turn - 4] if turn in (5, 7) else [])
        return max([1 + depth(conv, t) for t in before if (conv, t) in calls], default=0)

    broken = Counter()
    for (conv, turn), text in calls.items():
        r = found[conv, f"{conv}:{turn}", True]
        errors = []
        if text is None:
            errors = ["$.text: missing"]
        elif not 1 <= len(text) <= 1500:
            errors = ["$.text: too long" if text else "$.text: too short"]
        if turn > 200:
            errors.append("$.turn: above maximum")
        assert r["errors"] == "; ".join(errors) and r["valid"] == (not errors)
        broken[bool(errors)] += 1
        result = others.get((conv, turn))
        assert r["status"] == ("linked" if (conv, turn) in others else "no result")
        assert r["depth"] == depth(conv, turn)
        arguments = {"turn": turn} | ({"text": text} if text is not None else {})
        want = {"arguments": arguments, "call_id": f"{conv}:{turn}", "conv_id": conv, "name": "reply", "result": result}
        assert r["json"] == _plain_json(want)
    assert broken[False] and broken[True]
    by_conv = defaultdict(list)
    for r in rows:
        by_conv[r["conv_id"]].append(r)
    for own in by_conv.values():
        own.sort(key=lambda r: r["position"])
        assert [r["position"] for r in own] == list(range(len(own)))
        depths = [r["depth"] for r in own if r["status"] != "orphan result"]
        assert depths == sorted(depths) and None not in depths


def test_licenses(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").withColumn("path", document_path()).collect()
    named = [(k, licenses.words(x)) for k, v in licenses.TEMPLATES.items() for x in v]
    vocabulary = {w for _, c in named for w in c}
    df, n = Counter(), len(docs)
    for d in docs:
        df.update(vocabulary & set(licenses.words(d["text"] or "")))
    idf = {w: math.log((1 + n) / (1 + df[w])) + 1 for w in vocabulary}
    other = math.log(1 + n) + 1

    def cosine(found, template):
        a, b = Counter(found), Counter(template)
        size = lambda c: math.sqrt(sum((k * idf.get(w, other)) ** 2 for w, k in c.items() if w in idf)
                                   + sum(k for w, k in c.items() if w not in idf) * other**2)
        return sum(a[w] * k * idf[w] ** 2 for w, k in b.items()) / (size(a) * size(b) or 1)

    def best(line):
        """All templates with a line, and with every run of words as long as a template."""
        found = licenses.words(line)
        for name, template in named:
            if found and (x := cosine(found, template)) >= 0.8:
                yield -round(x, 6), name

    def runs(text):
        found = licenses.words(text)
        for name, template in named:
            for word in set(template) & set(found):
                for i in [i for i, w in enumerate(found) if w == word]:
                    start = max(0, i - template.index(word))
                    x = cosine(found[start : start + len(template)], template)
                    if x >= 0.8:
                        yield -round(x, 6), name

    own, files = {}, {}
    for d in docs:
        text = (d["text"] or "").replace("\r", "\n")
        lines = text.split("\n") + [text] * d["path"].endswith("/LICENSE")
        found = [x for line in lines for x in best(line)] + list(runs(text))
        own[d["doc_id"]] = min(found, default=None)
        if own[d["doc_id"]] and d["path"].endswith("/LICENSE"):
            folder = d["path"].rpartition("/")[0]
            top = (*own[d["doc_id"]], d["path"])
            files[folder] = min(files.get(folder, top), top)
    expected = {}
    for d in docs:
        at, top = d["path"].rpartition("/")[0], None
        while at and top is None:
            top, at = files.get(at), at.rpartition("/")[0]
        mine = own[d["doc_id"]]
        expected[d["doc_id"]] = (
            (mine[1], "own", None) if mine else (top[1], "inherited", top[2]) if top
            else (None, "none", None)
        )
    found = QUERIES["op9_licenses"](spark, sf_dir).collect()
    assert len(found) == n
    assert {r["doc_id"]: (r["license"], r["found"], r["from_path"]) for r in found} == expected
    assert any(r["found"] == "own" for r in found)


def test_sharding(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in read(spark, sf_dir, "documents").collect()}
    rows = QUERIES["op10_sharding"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    slots = defaultdict(list)
    for r in rows:
        data = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
        assert r["grown_shard"] in (r["shard"], 24)
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(24))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_pipeline(spark, sf_dir):
    docs, kept = read(spark, sf_dir, "documents"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, sf_dir), "test-stage")
        assert docs.columns == corpus_pipeline.DOCUMENT
        kept.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    assert all(later <= earlier for earlier, later in zip(kept, kept[1:], strict=False))
    labels = read(spark, sf_dir, "labels").collect()
    clean = {r["doc_id"] for r in labels if r["quality"] == 1 and r["toxic"] == 0}
    assert len(clean & kept[0]) >= 0.95 * len(clean)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == kept[-1]
