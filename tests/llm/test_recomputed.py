"""Operators and the pipeline beside plain recomputations that share no code with them."""

from __future__ import annotations

import io
import math
import random
import re
import struct
import zipfile
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from areaneed.llm.quality import classify, site_posteriors
from areaneed.llm.sharding import shuffle_shards
from areaneed.llm.warc import members, read_archives, write_archives

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def sigmoid(z):
    return 1 / (1 + math.exp(-z))


def log_odds(p):
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def beta_strength(rates, sizes, parents, free, mean):
    """Pseudo-documents: spread of the rates round their parents' beyond that of chance."""
    spread = sum(n * (r - p) ** 2 for n, r, p in zip(sizes, rates, parents, strict=True))
    chance = mean * (1 - mean)
    between = (spread - chance * free) / sum(sizes)
    return min(max(chance / between - 1, 1), 1e4) if between > 0 else 1e4


def plain_posteriors(rows, rates, head):
    """(host, path) -> rate of one head; ``rows``: (host, path, evidence of the head)."""
    paths, hosts = defaultdict(list), defaultdict(list)
    for host, path, evidence in rows:
        label = sigmoid(evidence + log_odds(rates[head]))
        paths[host, path].append(label)
        hosts[host].append(label)
    mean = sum(map(sum, hosts.values())) / len(rows)
    host_rate = {h: sum(x) / len(x) for h, x in hosts.items()}
    path_rate = {k: sum(x) / len(x) for k, x in paths.items()}
    keys = list(paths)
    k_host = beta_strength(
        host_rate.values(),
        [len(x) for x in hosts.values()],
        [mean] * len(hosts),
        len(hosts) - 1,
        mean,
    )
    k_path = beta_strength(
        path_rate.values(),
        [len(x) for x in paths.values()],
        [host_rate[h] for h, _ in keys],
        len(keys) - len(hosts),
        mean,
    )
    out = {}
    for host, path in keys:
        n, x = len(paths[host, path]), sum(paths[host, path])
        prior = (sum(hosts[host]) + k_host * mean) / (len(hosts[host]) + k_host)
        out[host, path] = (x + k_path * prior) / (n + k_path)
    return out


def evidence_rows(spread: float):
    """A host with a third of all rows, sparse sites, a null host and a null path."""
    rng = random.Random(1)
    rows = []
    for i in range(900):
        host = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", "d", None])
        path = rng.choice(["x", "y", None]) if host != "d" else f"p{i}"
        shift = spread * ((hash_of(str(host)) % 7) - 3 + 0.5 * ((hash_of(str(path)) % 5) - 2))
        rows.append((host, path, rng.gauss(shift, 1.5), rng.gauss(-shift, 1.0)))
    return rows


def hash_of(text: str) -> int:
    return zlib.crc32(text.encode())


@pytest.mark.parametrize("spread", [0.0, 0.6])
def test_site_posteriors_beside_plain_recomputation(spark, spread):
    rows = evidence_rows(spread)
    frame = spark.createDataFrame(
        rows, "host string, path string, quality_evidence double, toxic_evidence double"
    )
    rates = {"quality": 0.7, "toxic": 0.1}
    found = site_posteriors(frame, rates).collect()
    for j, head in enumerate(("quality", "toxic")):
        expected = plain_posteriors([(r[0], r[1], r[2 + j]) for r in rows], rates, head)
        assert len(found) == len(expected)
        for r in found:
            assert r[f"{head}_rate"] == pytest.approx(expected[r["host"], r["path"]], rel=1e-9)
        # Sparse sites lie between the global rate and what their few documents say.
        assert all(0 < p < 1 for p in expected.values())


def test_labels_move_sites_without_evidence_of_their_own(spark):
    """Null texts have no evidence: their probability is the rate of their site."""
    rng = random.Random(2)
    good, bad = "calm river stone light".split(), "buy cheap now click".split()
    rows = []
    for i in range(600):
        poor = i % 2
        text = " ".join(rng.choice(bad if poor else good) for _ in range(40))
        rows.append((i, text, "spam" if poor else "news", "p"))
    rows += [(1000, None, "spam", "p"), (1001, None, "news", "p"), (1002, "", "news", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, site string, dir string")
    labels = spark.createDataFrame(
        [(i, 1 - i % 2, 0) for i in range(300)], "doc_id long, quality int, toxic int"
    )
    out = {r["doc_id"]: r for r in classify(docs, labels, F.col("site"), F.col("dir")).collect()}
    assert len(out) == len(rows)
    assert not out[1000]["keep"] and out[1001]["keep"] and out[1002]["keep"]
    assert out[1001]["quality"] == out[1002]["quality"] > 0.9 > 0.1 > out[1000]["quality"]


def test_without_the_texts_documents_are_judged_alike(spark, sf_dir):
    docs = corpus_pipeline.read(spark, sf_dir, "documents").withColumn("row", F.lit("r"))
    nulls = {c: F.lit(None).cast(t) for c, t in (("doc_id", "long"), ("text", "string"), ("lang", "string"))}
    docs = docs.unionByName(docs.limit(1).withColumns(nulls))
    labels = corpus_pipeline.read(spark, sf_dir, "labels")
    site = {"host": F.col("source"), "path": F.col("lang")}
    judged = ["doc_id", "row", "quality", "toxicity", "keep"]
    whole = classify(docs, labels, **site).select(*judged).collect()
    thin = classify(docs, labels, **site, columns=["row", "doc_id", "keep"])
    assert thin.columns == ["row", "doc_id", "quality", "toxicity", "keep"]
    order = lambda r: str(r["doc_id"])
    for a, b in zip(sorted(whole, key=order), sorted(thin.collect(), key=order), strict=True):
        assert (a["doc_id"], a["row"], a["keep"]) == (b["doc_id"], b["row"], b["keep"])
        assert a["quality"] == pytest.approx(b["quality"], abs=1e-9)
        assert a["toxicity"] == pytest.approx(b["toxicity"], abs=1e-9)
    empty = classify(docs.limit(0), labels, **site, columns=["doc_id"])
    assert empty.count() == 0
    with pytest.raises(ValueError, match="no column"):
        classify(docs, labels, **site, columns=["keep"])


def chained_hash(*parts: bytes) -> int:
    seed = 42
    for part in parts:
        seed = xxhash.xxh64(part, seed=seed).intdigest()
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def plain_shard(doc_id, shards):
    def score(i):
        key = [] if doc_id is None else [struct.pack("<q", doc_id)]
        return chained_hash(struct.pack("<i", 0), *key, struct.pack("<i", i)), i

    return max(score(i) for i in range(shards))[1]


def test_shards_beside_plain_rendezvous(spark):
    texts = [None, "", "same", "ñ😀"]
    rows = [(i, texts[i % 4]) for i in range(700)] + [(None, "no id"), (5, "again"), (-9, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = shuffle_shards(docs, shards=24, bucket_bytes=64).collect()
    grown = shuffle_shards(docs, shards=25, bucket_bytes=64).collect()
    key = lambda r: (str(r["doc_id"]), str(r["text"]))
    assert sorted(map(key, found)) == sorted(map(key, grown)) == sorted((str(i), str(t)) for i, t in rows)
    after = {key(r): r["shard"] for r in grown}
    slots, ids = defaultdict(list), defaultdict(list)
    for r in found:
        assert r["shard"] == plain_shard(r["doc_id"], 24)
        assert r["grown_shard"] == plain_shard(r["doc_id"], 25) == after[key(r)]
        assert r["grown_shard"] in (r["shard"], 24)
        assert r["size"] == len((r["text"] or "").encode()) + 8
        slots[r["shard"]].append(r["slot"])
        ids[r["shard"]].append((r["slot"], r["doc_id"] or 0))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    in_order = [[i for _, i in sorted(x)] for x in ids.values()]
    assert sum(x == sorted(x) for x in in_order) < 3


class Bytes:
    """A file in memory as the reader sees one."""

    def __init__(self, data: bytes):
        self.data = data

    def read_at(self, n, at):
        return self.data[at : at + n]


def listed(data: bytes) -> dict[str, bytes]:
    found = members(Bytes(data), len(data))
    return {name: data[at : at + n] for name, (at, n) in found.items()}


@pytest.mark.parametrize("comment", [b"", b"a PK\x05\x06 in a comment", b"PK\x05\x06" * 2000, b"c" * 65_535])
def test_members_of_a_foreign_archive(comment):
    file = io.BytesIO(b"bytes before the archive" * 3)
    with zipfile.ZipFile(file, "w") as pack:
        pack.comment = comment
        pack.writestr("a/stored", b"12345")
        pack.writestr("packed", b"1" * 1000, zipfile.ZIP_DEFLATED)
        with pack.open("b/större", "w", force_zip64=True) as out:
            out.write(b"wide")
        pack.writestr("empty", b"")
    assert listed(file.getvalue()) == {"a/stored": b"12345", "b/större": b"wide", "empty": b""}


def test_members_of_an_archive_with_a_zip64_end():
    file = io.BytesIO()
    with zipfile.ZipFile(file, "w") as pack:
        for i in range(65_600):
            pack.writestr(zipfile.ZipInfo(str(i)), b"%d" % i)
        pack.comment = b"PK\x05\x06 and more"
    found = listed(file.getvalue())
    assert len(found) == 65_600 and found["65599"] == b"65599" and found["0"] == b"0"


@pytest.mark.parametrize("data", [b"", b"no archive", b"PK\x05\x06", b"PK\x05\x06" + b"\xff" * 30])
def test_files_that_are_no_archives_are_refused(data):
    with pytest.raises(ValueError, match="no end"):
        members(Bytes(data), len(data))


def test_archives_with_small_ranges_and_repeated_ids(spark):
    big, other = "p" * 5000, "é" * 3000
    pages = [(1, "u", big), (1, "v", big), (2, "w", big), (3, "x", other), (4, "y", "s" * 99), (5, "z", "s" * 99)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    manifest = write_archives(df, archive_bytes=4000)
    assert manifest.count() > 1
    out = sorted(
        (r["page_id"], r["url"], r["record_type"], r["refers_to"], r["payload_bytes"])
        for r in read_archives(manifest, range_bytes=100).collect()
    )
    assert out == [
        (1, "u", "response", None, 5000),
        (1, "v", "response", None, 5000),
        (2, "w", "revisit", 1, 5000),
        (3, "x", "response", None, 6000),
        (4, "y", "response", None, 99),
        (5, "z", "response", None, 99),
    ]


def plain_words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, text or "")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def survivors(docs):
    """Smallest row of each group of near copies, all pairs compared."""
    sets = {}
    for i, text in docs.items():
        w = plain_words(lowered(text))
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in docs}
    for a in sorted(docs):
        for b in sorted(docs):
            both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if a < b and sets[a] and sets[b] and 4 * both >= 3 * either:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {i: new if r == old else r for i, r in root.items()}
    return {i: t for i, t in docs.items() if root[i] == i}


def cut(docs, window=50):
    """Words covered by a window that an earlier document has are taken out."""
    starts = {}
    words = {i: plain_words(t) for i, t in docs.items()}
    for i in sorted(words):
        for j in range(len(words[i]) - window + 1):
            starts.setdefault(tuple(words[i][j : j + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for j in range(len(w) - window + 1):
            if starts[tuple(w[j : j + window])] < i:
                gone.update(range(j, j + window))
        out[i] = [x for j, x in enumerate(w) if j not in gone]
    return out


def clean(docs, items, window=10):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    runs = set()
    for text in items:
        w = plain_words(lowered(text), pattern)
        runs |= {tuple(w[j : j + window]) for j in range(max(1, len(w) - window + 1)) if w}
    sizes = {len(r) for r in runs}
    out = {}
    for i, words in docs.items():
        w = plain_words(lowered(" ".join(words)), pattern)
        if not any(tuple(w[j : j + n]) in runs for n in sizes for j in range(len(w) - n + 1)):
            out[i] = words
    return out


def made_up():
    rng = random.Random(3)
    some = lambda n: [f"{rng.choice(LETTERS)}{rng.randrange(4000)}" for _ in range(n)]
    passage, question = some(70), some(14)
    docs = {i: some(rng.randrange(1, 200)) for i in range(40)}
    docs[7] = docs[3][:]
    docs[8] = docs[4] + ["more"]
    docs[9] = ["new", *docs[8]]
    for i in (10, 11, 12):
        docs[i] = some(80) + passage + some(80)
    docs[13] = some(30) + question + some(30)
    docs[14] = [w.upper() for w in some(30) + question[2:13] + some(30)]
    docs[15] = some(9000)
    # The benchmark passage lies in what substring dedup takes out of the later document.
    docs[16] = some(60) + (shared := some(25) + question[:12] + some(25))
    docs[17] = some(60) + shared + some(60)
    texts = {i: (" " if i % 2 else "\n").join(w) for i, w in docs.items()}
    texts[18], texts[19], texts[20] = None, "", " \n\t "
    return texts, [" ".join(question), None, "", "two words"]


def write_tables(spark, folder, docs, items):
    """Documents with columns that stages add themselves, without labels."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs]
    frame = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    )
    for name in ("n_words", "keep", "component_id", "items", "host", "row", "quality", "ids"):
        frame = frame.withColumn(name, F.lit("z"))
    frame.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    spark.createDataFrame(
        [(f"q{i}", t) for i, t in enumerate(items)], "item_id string, text string"
    ).write.parquet(f"{folder}/benchmark.parquet")


def test_pipeline_beside_plain_version(spark, tmp_path):
    from tokenizers import Tokenizer

    texts, items = made_up()
    write_tables(spark, tmp_path, texts.items(), items)
    expected = clean(cut(survivors(texts)), items)
    assert {7, 8, 9, 13, 14, 16} & expected.keys() == set() and {3, 10, 12, 17} <= expected.keys()
    docs = corpus_pipeline.read(spark, str(tmp_path), "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, str(tmp_path)), "plain-stage")
        assert docs.columns == corpus_pipeline.DOCUMENT, name
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {i: plain_words(t) for i, t in kept.items()} == expected
    # Texts that lost no word are as they were.
    same = [i for i in kept if plain_words(texts[i]) == expected[i]]
    assert all(kept[i] == texts[i] for i in same) and len(same) > 20

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        pieces[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert pieces.keys() == kept.keys()
    for i, text in kept.items():
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            part = ids[at : at + r["length"]]
            assert (r["start"], r["ids_crc32"], r["doc_tokens"]) == (at, zlib.crc32(part.tobytes()), len(ids))
            at += r["length"]
        assert at == len(ids)
    for parts in bins.values():
        ends = [a + n for a, n in sorted(parts)]
        assert [a for a, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 4096


@pytest.mark.parametrize("case", ["empty", "odd"])
def test_every_stage_on_odd_tables(spark, tmp_path, case):
    """Empty tables; repeated and null ids, null, empty and very long texts, clashing names."""
    long = " ".join(f"w{i}" for i in range(30_000))
    odd = [(1, "a b c"), (1, "a b c"), (None, "a b c"), (None, None), (2, None), (3, ""), (4, long), (5, long)]
    write_tables(spark, tmp_path, odd if case == "odd" else [], ["a"] if case == "odd" else [])
    whole = corpus_pipeline.read(spark, str(tmp_path), "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = stage(spark, whole, str(tmp_path)).collect()
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    if case == "empty":
        assert not rows and not any(seen.values())
        return
    ids = {name: sorted(str(r["doc_id"]) for r in found) for name, found in seen.items()}
    every = sorted(str(i) for i, _ in odd)
    assert ids["quality classifier"] == ids["substring dedup"] == every
    assert ids["n-gram Jaccard join"] == sorted(x for x in every if x != "5")
    assert ids["benchmark decontamination"] == ["2", "3", "4", "5", "None"]
    assert set(ids["packing"]) == set(every)
    assert {r["doc_id"] for r in rows} == {None, 2, 3, 4}
