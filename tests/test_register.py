"""Keyed tables and the register: what a day rewrites, and any order of days."""

from __future__ import annotations

import datetime as dt
import itertools
import os
import random

import pytest

from areaneed.plans.register import Register
from areaneed.sources.keyed import PART, key_part, read_rows, upsert_keyed, with_part

ROW = "entityid string, status string, city string, seq int, source_date date"


def day(n: int) -> dt.date:
    return dt.date(2024, 3, n)


def files(path) -> dict[str, set[str]]:
    """Folder -> its data files."""
    out = {}
    for folder, _, names in os.walk(path):
        if data := {x for x in names if x.startswith("part-")}:
            out[os.path.relpath(folder, path)] = data
    return out


@pytest.fixture
def frame(spark):
    return lambda rows: spark.createDataFrame(rows, ROW)


def parts_of(spark, names, parts):
    df = spark.createDataFrame([(x,) for x in names], "entityid string")
    return {r[0]: r[1] for r in df.select("entityid", key_part("entityid", parts)).collect()}


def test_upsert_rewrites_only_the_parts_of_its_keys(spark, frame, tmp_path):
    path, names = str(tmp_path / "t"), [f"e{i}" for i in range(40)]
    upsert_keyed(frame([(x, "a", "c", 1, day(1)) for x in names]), path, "entityid", 8)
    before, where = files(path), parts_of(spark, names, 8)
    batch = frame([("e3", None, "new", 2, day(2)), (None, "x", "x", 1, day(2)), ("e4", "b", None, 0, None)])
    touched = upsert_keyed(batch, path, "entityid", 8, ["source_date", "seq"])
    after = files(path)
    assert set(touched) == {where["e3"], where["e4"]}
    for folder, names_ in before.items():
        assert (after[folder] == names_) == (int(folder.split("=")[1]) not in touched)
    rows = read_rows(spark, path, with_part(batch.schema), "entityid").collect()
    found = {r["entityid"]: tuple(r)[1:5] for r in rows}
    assert len(rows) == 40 and found["e3"] == (None, "new", 2, day(2))
    assert found["e4"] == ("a", "c", 1, day(1)), "a null comes before any day"
    assert upsert_keyed(batch.limit(0), path, "entityid", 8) == []
    assert files(path) == after


def test_keyed_reads_only_the_parts_it_needs(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    upsert_keyed(frame([(f"e{i}", "a", "c", 1, day(1)) for i in range(40)]), path, "entityid", 8)
    rows = read_rows(spark, path, with_part(frame([]).schema), "entityid").where(f"{PART} = 3")
    assert "PartitionFilters: [isnotnull(key_part" in rows._jdf.queryExecution().toString()


def expected(days: dict) -> tuple[set, set]:
    """Newest rows and versions of landed days (day -> rows)."""
    newest, versions = {}, []
    for d in sorted(days):
        best = {}
        for r in days[d]:
            if r[0] is not None and (r[0] not in best or r[3] > best[r[0]][3]):
                best[r[0]] = r
        for key, r in best.items():
            if key not in newest or newest[key][1] != r[1]:
                versions.append((r, d))
            newest[key] = r
    out = set()
    for r, start in versions:
        ends = [d for other, d in versions if other[0] == r[0] and d > start]
        out.add((*r, start, min(ends, default=None)))
    return set(newest.values()), out


def state(register) -> tuple[set, set]:
    current = [tuple(r) for r in register.current().select("entityid", "status", "city", "seq", "source_date").collect()]
    rows = register.history().collect()
    versions = [(r["entityid"], r["status"], r["city"], r["seq"], r["source_date"],
                 r["valid_from"].date(), r["valid_to"] and r["valid_to"].date()) for r in rows]
    assert len(current) == len(set(current)) and len(versions) == len(set(versions))
    assert len({r["scd_id"] for r in rows}) == len(rows)
    return set(current), set(versions)


def made(n: int, rng) -> list[tuple]:
    keys = rng.sample([None, *[f"e{i}" for i in range(8)]], 5)
    rows = [(k, rng.choice(["a", "b", None]), rng.choice("xy"), i, day(n)) for i, k in enumerate(keys)]
    return rows + [(keys[0], "again", "z", 9, day(n))]


def register(spark, frame, path) -> Register:
    return Register(spark, str(path), frame([]).schema, "entityid", ["seq"], ["status"], parts=4)


def test_days_in_any_order_give_the_same_tables(spark, frame, tmp_path):
    rng = random.Random(2)
    days = {day(n): made(n, rng) for n in (1, 2, 3)}
    want = expected(days)
    for i, order in enumerate(list(itertools.permutations(days))[::2]):
        reg = register(spark, frame, tmp_path / str(i))
        for d in order:
            reg.run(frame(days[d]))
        assert state(reg) == want
    # A corrected day: some entities change, some are no longer in it, one is only there.
    days[day(2)] = [("e1", "fixed", "x", 1, day(2)), ("only", "a", "x", 1, day(2))]
    reg.run(frame(days[day(2)]))
    assert state(reg) == expected(days)
    days[day(2)] = [("e1", "fixed", "x", 1, day(2))]
    reg.run(frame(days[day(2)]))
    assert state(reg) == expected(days)
    reg.run(frame([]))
    assert state(reg) == expected(days)


def test_a_day_without_changes_closes_nothing(spark, frame, tmp_path):
    reg = register(spark, frame, tmp_path)
    rows = [(f"e{i}", "a", "x", 1, day(1)) for i in range(20)]
    reg.run(frame(rows))
    opened = files(tmp_path / "open")
    reg.run(frame([(k, s, "moved", 2, day(2)) for k, s, *_ in rows]))
    assert not os.path.exists(tmp_path / "closed") and files(tmp_path / "open") == opened
    reg.run(frame([("e5", "b", "x", 1, day(3))]))
    closed = files(tmp_path / "closed")
    assert list(closed) == [f"closed_on={day(3)}"]
    where = parts_of(spark, ["e5"], 4)["e5"]
    changed = {k for k, v in files(tmp_path / "open").items() if v != opened.get(k)}
    assert changed == {f"{PART}={where}"}
    reg.run(frame([("e6", "b", "x", 1, day(4))]))
    later = files(tmp_path / "closed")
    assert later[f"closed_on={day(3)}"] == closed[f"closed_on={day(3)}"] and len(later) == 2


def test_a_late_day_redoes_only_its_keys(spark, frame, tmp_path):
    reg = register(spark, frame, tmp_path)
    days = {day(1): [(f"e{i}", "a", "x", 1, day(1)) for i in range(20)],
            day(3): [("e1", "b", "x", 1, day(3)), ("e2", "a", "x", 1, day(3))],
            day(5): [("e7", "b", "x", 1, day(5))]}
    for rows in days.values():
        reg.run(frame(rows))
    opened, closed = files(tmp_path / "open"), files(tmp_path / "closed")
    days[day(2)] = [("e2", "b", "x", 1, day(2))]
    reg.run(frame(days[day(2)]))
    where = parts_of(spark, ["e2"], 4)["e2"]
    changed = {k for k, v in files(tmp_path / "open").items() if v != opened[k]}
    assert changed == {f"{PART}={where}"}
    after = files(tmp_path / "closed")
    assert after[f"closed_on={day(5)}"] == closed[f"closed_on={day(5)}"]
    assert state(reg) == expected(days)
