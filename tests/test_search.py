"""The name index gives what a scan gives, and reads only what it needs."""

from __future__ import annotations

import random

import pytest

from areaneed.plans import portal
from areaneed.plans.search import build_index

NAMES = ["Acme 42", "acme tools", "Zeta", None, "ab", "", "100% pure_x", "Ünïcode Äcme", "aaaa", "AAA",
         "O'Neil \\ Sons", "Straße 7", "Acme 42"]


@pytest.fixture(scope="module")
def lookup(spark):
    random.seed(4)
    made = ["".join(random.choices("abcde ", k=random.randrange(2, 12))) for _ in range(300)]
    rows = [(i * 7, name, i) for i, name in enumerate(NAMES + made)]
    return spark.createDataFrame(rows, "entity_id bigint, entity_name string, other int").cache()


@pytest.fixture(scope="module")
def index(lookup, tmp_path_factory):
    return build_index(lookup, str(tmp_path_factory.mktemp("names") / "i"), parts=4)


@pytest.mark.parametrize(
    "term",
    ["acme", "ACME 42", "me", "a", "äcme", "100%", "pure_", "%", "aaa", "aaaa", "abc", "cde ab", "qqq", "abq",
     "42", "84", "07", "7", "\\ S", "neil", " zeta ", "99999999999999999999", "ße", "abcabcabc"],
)
@pytest.mark.parametrize("rarest", [1, 3])
def test_same_answers_as_a_scan(lookup, index, term, rarest):
    for rows in (5, 101):
        want = portal.search_businesses(lookup, term, max_rows=rows).collect()
        assert index.search(term, max_rows=rows, rarest=rarest).collect() == want


def test_empty_term_and_empty_lookup(spark, lookup, index, tmp_path):
    assert index.search("  ") is None
    none = build_index(lookup.limit(0), str(tmp_path / "i"))
    assert none.search("acme").count() == none.search("ac").count() == 0


def test_only_postings_and_parts_that_are_needed_are_read(index):
    plan = index.search("zeta")._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan" in x]
    assert len(scans) == 2 and all("PartitionFilters: [" in x and "IN (" in x or "= " in x for x in scans)
    assert any("postings" in x and "PushedFilters: [In(gram" in x for x in scans)
    by_id = index.search("84")._jdf.queryExecution().executedPlan().toString()
    assert "isnotnull(key_part" in by_id and "EqualTo(entity_id,84)" in by_id
