"""Fill-in-the-middle, source divergence and exact copies on made-up rows, beside plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from areaneed.llm.divergence import source_divergence
from areaneed.llm.exact import drop_copies, mark_copies, text_digest
from areaneed.llm.fim import arranged, fill_in_middle, restore_text, restored, rotate

LONG = " ".join(f"wörd{i}" for i in range(60_000))


def test_rotation_exchanges_blocks():
    for size in range(7):
        for lo in range(size + 1):
            for hi in range(lo, size + 1):
                for mid in range(lo, hi + 1):
                    data = bytearray(range(size))
                    rotate(data, lo, mid, hi)
                    old = bytes(range(size))
                    assert bytes(data) == old[:lo] + old[mid:hi] + old[lo:mid] + old[hi:]


@pytest.mark.parametrize("text", [b"a", b"ab<", b"<S<PM>>", b"P>x<M", "añ😀<".encode(), b"<<<>>>"])
def test_every_cut_comes_back(text):
    for x in range(len(text) + 1):
        for y in range(x, len(text) + 1):
            p, m, s = text[:x], text[x:y], text[y:]
            psm, spm = arranged(text, x, y, "psm"), arranged(text, x, y, "spm")
            assert psm == b"<P>" + p + b"<S>" + s + b"<M>" + m
            assert spm == b"<S>" + s + b"<P>" + p + b"<M>" + m
            assert restored(psm, "psm") == restored(spm, "spm") == text


def test_fill_in_middle_cases(spark):
    texts = ["", None, "one <S> two", "x", LONG, "ñ" * 50, "same", "same"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (6, "same"), (-4, "negative")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({c: F.lit("y") for c in ("n", "id", "other", "row", "output", "form")})
    done = restore_text(fill_in_middle(docs, percent=100)).collect()
    assert sorted(str(r["doc_id"]) for r in done) == sorted(str(i) for i, _ in rows)
    for r in done:
        text = r["text"] or ""
        assert r["restored"] == text and r["id"] == r["other"] == r["row"] == "y"
        assert r["n"] == len(text)
        h = hashlib.sha256(f"1:{r['doc_id']}".encode()).hexdigest()
        h1, h2, _, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
        if text in ("", "one <S> two", "no id"):
            assert (r["form"], r["output"], r["prefix_chars"]) == ("plain", text, None)
            continue
        a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
        p, m, s = text[:a], text[a:b], text[b:]
        assert (r["prefix_chars"], r["middle_chars"]) == (a, b - a)
        assert r["form"] == ("spm" if h4 % 100 < 20 else "psm")
        psm, spm = f"<P>{p}<S>{s}<M>{m}", f"<S>{s}<P>{p}<M>{m}"
        assert r["output"] == (spm if r["form"] == "spm" else psm)
    assert restore_text(fill_in_middle(docs.limit(0))).count() == 0
    assert {r["form"] for r in fill_in_middle(docs, percent=0).collect()} == {"plain"}
    with pytest.raises(ValueError, match="named like"):
        fill_in_middle(docs, text_col="output")


def _divergence(rows, least, top):
    letters = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = letters.findall(small)
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= least]
        others = sorted(s for g, s in groups if g == lang)

        def share(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {
                t: 1 + 1_000_000_000 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept
            }

        whole = Counter()
        for s in others:
            whole += counts[lang, s]
        p, q = share(counts[lang, source]), share(whole)
        pairs = []
        for s in others:
            other = share(counts[lang, s])
            pairs.append((-sum(abs(p[t] - other[t]) for t in kept), s.encode(), s))
        pairs = sorted(x for x in pairs if x[2] != source)
        own = counts[lang, source]
        terms = sorted((q[t] - p[t], t.encode(), t) for t in kept if own[t] and p[t] > q[t])
        for part, found in (("pair", pairs), ("term", terms[:top])):
            for rank, (value, _, item) in enumerate(found, 1):
                out.add((lang, source, part, item, -value, rank))
    return out


def test_source_divergence(spark):
    random.seed(5)
    words = ["Al", "be", "CÉ", "ça", "d", "É", "zz", "ΑΣ", "x1y", "ß", "it's", "的"]
    rows = [
        (lang, source, " ".join(random.choices(words[: 4 + k], k=random.randrange(9))))
        for lang in ("en", "de")
        for k, source in enumerate(["a", "b", "B", "é", "c", ""])
        for _ in range(9)
    ]
    copy = "Al be be be zz"
    rows += [("en", "a", copy)] * 40 + [("en", "b", copy)] * 7 + [("de", "a", copy), ("xx", "a", LONG)]
    rows += [(None, None, None), (None, "s", copy), ("en", None, copy), ("en", "none", None), ("en", "none", "123")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    docs = docs.withColumns({c: F.lit(1) for c in ("n", "term", "p", "digest", "value", "v", "total")})
    for least, top, block in ((3, 4, 500_000), (1, 50, 5), (10_000, 50, 5)):
        found = source_divergence(docs, least_docs=least, top=top, block_rows=block).collect()
        assert len(found) == len(set(found))
        assert {tuple(r) for r in found} == _divergence(rows, least, top)
    assert source_divergence(docs.limit(0)).count() == 0


def test_source_divergence_of_large_counts_is_exact(spark):
    from areaneed.llm import divergence

    rows = [("en", s, f"t x") for s in "ab" for i in range(6)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    real, factor = divergence._term_sums, 10**13 + 7
    divergence._term_sums = lambda base: real(base).withColumns(
        {
            "lang_n": F.col("lang_n") * factor,
            "entries": F.transform(
                "entries", lambda x: x.withField("n", x["n"] * factor)
            ),
        }
    )
    try:
        found = source_divergence(docs, least_docs=1).collect()
    finally:
        divergence._term_sums = real
    pairs = [r for r in found if r["part"] == "pair"]
    assert [r["value"] for r in pairs] == [0, 0]  # equal counts, whatever their size


@pytest.mark.parametrize("counters", [1, 3, 1024])
def test_exact_copies(spark, counters):
    random.seed(counters)
    texts = ["", None, " ", "\t\n", "a b", "a  b", "a\x0bb", " a b", "a b", LONG, LONG + "\n"]
    rows = [(random.randrange(400) or None, t) for t in texts * 6]
    rows += [(random.randrange(5000), "frequent  text") for _ in range(300)]
    rows += [(7, "frequent text")] * 3 + [(None, "only nulls")] * 2 + [(9, f"own {i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    docs = docs.withColumns({c: F.lit("y") for c in ("digest", "id", "row", "first", "kept")}).cache()
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    named = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    smallest = {k: min((i for i in ids if i is not None), default=None) for k, ids in named.items()}
    marks = mark_copies(docs, counters=counters).collect()
    assert len(marks) == len(rows)
    kept, sizes = Counter(), Counter()
    for r in marks:
        key = bytes(r["digest"]).hex()
        sizes[key] += 1
        assert (r["keep_id"], r["group_size"]) == (smallest[key], len(named[key]))
        if r["kept"]:
            kept[key] += 1
            assert r["doc_id"] == smallest[key]
    assert set(kept.values()) == {1} and kept.keys() == named.keys()
    assert {k: len(v) for k, v in named.items()} == dict(sizes)
    left = drop_copies(docs, counters=counters)
    assert left.columns == docs.columns
    left = left.select("doc_id", text_digest(F.col("text")).alias("d")).collect()
    assert {bytes(r["d"]).hex(): r["doc_id"] for r in left} == smallest and len(left) == len(named)
    assert mark_copies(docs.limit(0)).count() == drop_copies(docs.limit(0)).count() == 0


def test_frequent_digests_are_decided_before_the_shuffle(spark):
    rows = [(i, "hot") for i in range(900)] + [(i, f"t{i}") for i in range(900, 1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    plan = mark_copies(docs, counters=8)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti, BuildRight" in plan and "BroadcastHashJoin" in plan
    from areaneed.llm.exact import _decided

    _, winners, groups = _decided(docs, "doc_id", "text", 8)
    assert [r["group_size"] for r in winners.where("group_size > 1").collect()] == [900]
    assert winners.count() <= 9 and groups.count() == 0
