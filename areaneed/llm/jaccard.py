"""Similarity join on word n-grams: T-occurrence search with DivideSkip.

Two sets of sizes a and b reach the similarity p/q only if they share T(a, b) =
ceil(p (a + b) / (p + q)) elements, and a set of size a can be without at most a - ceil(p a / q)
of them. So two linked sets share c of the a - ceil(p a / q) + c elements of each that come
first in any one order of all elements (c grows with a, below). Here the order is: elements with
short inverted lists by their hash, then elements with long ones.

1. One pass counts, over all texts, the elements that many different sets have (the long
   lists), and gives each document its set's fingerprint. Equal sets go on as one.
2. A second pass sends only the leading elements of each set to their inverted lists. Every
   list names one of its sets as centre and its members join the centre's group; members of
   long lists know the centre from step 1, so no long list meets in a task. A set with fewer
   than c shared lists goes no further. Each set leaves its least groups as long as it leaves
   fewer than c / 2 lists that way: two linked sets still meet in a group.
3. Every group gets its texts and is searched: for each set the short lists of the group are
   merged by counting, the long ones are probed by binary search for the sets that can
   still reach T. Only links that join two parts are returned.
   A group too large for a task is dealt by set size and hash into blocks, and each block is searched
   alone; then a few sets of each block's largest component are searched together. Sets of the
   group's largest component need no other links among themselves. All other sets travel on to every
   block that can hold a link of theirs. So near copies, which end in one component, travel twice
   however many they are; copies grow with the sets that are like no others.
4. Connected components of the links, over all groups.

Elements are 64-bit hashes of their words; sets are told apart by 128 bits.
"""

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areaneed.llm.components import connected_components
from areaneed.llm.words import LOWER, U64, Words, chunks, grams, int64, mix, text_column
from areaneed.sources.scratch import materialise

_ROUND = 4_000_000  # elements counted together in a task
_LOCAL = 4  # different sets of a round that make an element's list long
_LONG = 16  # and of all rounds
_MAX_LONG = 1 << 18  # a bound of the broadcast; beyond it the longest lists are meant
_SLOTS = 1 << 20  # of document ids, a bound of the other broadcast
_MU = 0.01  # DivideSkip's weight of a probe
_EXTRA = 8  # c is this part of the least overlap of a set
_SPEAKING = 8  # sets of a block's largest component that are searched with those of other blocks


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 5,
    similarity: tuple[int, int] = (3, 4),
    group_elements: int = 2_000_000,
) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_shingles`` and ``component_id``.

    The set of a document: its distinct runs of ``n`` words, with A-Z in lower case; with fewer
    words the whole sequence as one element. Two documents link when their Jaccard similarity
    is at least ``similarity`` (a fraction of whole numbers). ``component_id`` is the smallest
    id that can be reached over links, the document's own included.

    Null and empty texts have the empty set and link with nothing. A row with a null id
    has a null component and links with nothing. Rows with equal ids each have their own set, and
    what links with one is in the component of that id. Other columns are not read. An empty
    table gives an empty result.
    """
    base = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    p, q = similarity
    if not 0 < p <= q:
        raise ValueError("similarity must be above 0 and at most 1")
    seen = materialise(
        base.mapInArrow(partial(_count, n=n), "kind int, a long, b long, c long, d long"),
        "jaccard-counts",
    )
    sets = seen.where("kind = 0").select(
        F.col("a").alias("doc_id"),
        F.col("b").alias("n"),
        F.col("c").alias("fp"),
        F.col("d").alias("fp2"),
    )
    reps = materialise(
        sets.where("n > 0 and doc_id is not null")
        .groupBy("fp", "fp2", "n")
        .agg(F.min("doc_id").alias("doc_id")),
        "jaccard-sets",
    )
    long_lists = _long_lists(seen)
    overlap = f"(({p} * n + {q - 1}) div {q})"
    extra = f"(({overlap} + {_EXTRA - 1}) div {_EXTRA})"
    leading = reps.agg(F.sum(F.expr(f"n - {overlap} + {extra}"))).first()[0] or 0
    buckets = max(64, -(-leading // 1_000_000))
    postings = base.where("doc_id is not null").mapInArrow(
        partial(_postings, n=n, p=p, q=q, buckets=buckets, long_lists=long_lists),
        "bucket int, element binary, member binary, "
        "sure_member binary, sure_centre binary, sure_lists binary",
    )
    routes = postings.groupBy("bucket").applyInArrow(_lists, "fp long, centre long, lists long")
    routes = materialise(
        routes.groupBy("fp", "centre").agg(F.sum("lists").alias("lists")).join(reps, "fp"),
        "jaccard-routes",
    )
    by_set = Window.partitionBy("fp", "fp2")
    least = by_set.orderBy("lists", "centre").rowsBetween(Window.unboundedPreceding, 0)
    members = (
        routes.withColumn("c", F.expr(extra))
        .withColumn("all", F.sum("lists").over(by_set))
        .withColumn("left", F.sum("lists").over(least))
        .where("all >= c and 2 * left > c - 1")
        .select("centre", "fp", "doc_id", "n")
    )
    small, dealt = _blocks(members, group_elements, p, q)
    alone = dealt.select("doc_id", "fp", _block_key().alias("task"), "n")

    def search(table: pa.Table) -> pa.Table:
        return _search(table, n, p, q)

    def searched(searches: DataFrame, name: str) -> DataFrame:
        found = _routed(base, searches, group_elements)
        links = found.groupBy("shard").applyInArrow(search, "u long, v long")
        return materialise(links, f"jaccard-{name}-links")

    links = searched(small.unionByName(alone), "own")
    if not dealt.isEmpty():
        first = _largest(dealt, links, ["centre", "size", "part"])
        some = Window.partitionBy("centre", "size", "part").orderBy("fp", "doc_id")
        speaking = first.where("in_largest").withColumn("place", F.row_number().over(some))
        speaking = speaking.where(F.col("place") <= _SPEAKING)
        together = F.xxhash64("centre", F.lit(_SPEAKING)).alias("task")
        links = links.unionByName(
            searched(speaking.select("doc_id", "fp", together, "n"), "speaking")
        )
        rest = _largest(dealt, links, ["centre"]).where("not in_largest")
        rest = materialise(rest.select(*dealt.columns), "jaccard-rest")
        if not rest.isEmpty():
            links = links.unionByName(searched(_across(dealt, rest, group_elements), "rest"))
    parts = connected_components(links)
    by_set = reps.join(parts, reps["doc_id"] == parts["node"], "left").select(
        "fp", "fp2", "n", F.coalesce("component", "doc_id").alias("component")
    )
    # The ids of a component count however their rows are told apart.
    out = sets.join(by_set, ["fp", "fp2", "n"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )
    return out.withColumnRenamed("doc_id", id_col)


def _long_lists(seen: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Elements with long lists, sorted, and each one's centre. The bound changes work only."""
    rows = (
        seen.where("kind = 1")
        .groupBy("a")
        .agg(F.sum("b").alias("n"), F.min("c").alias("centre"))
        .where(F.col("n") >= _LONG)
        .orderBy(F.desc("n"), "a")
        .limit(_MAX_LONG)
        .select("a", "centre")
        .toPandas()
    )
    element = rows["a"].to_numpy(np.int64).view(U64)
    order = np.argsort(element)
    return element[order], rows["centre"].to_numpy(np.int64).view(U64)[order]


def _blocks(
    members: DataFrame, group_elements: int, p: int, q: int
) -> tuple[DataFrame, DataFrame]:
    """Searches (doc_id, fp, task, n) of the groups that fit a task; members of the larger ones
    with their block (``centre``, ``size`` class, ``part``)."""
    # Of linked sets the larger has at most q / p times the elements of the smaller, so with a ratio
    # just above that they are of the same size class or of neighbouring ones.
    ratio = F.log(F.lit(1.005 * q / p))
    size = F.floor(F.log(F.col("n").cast("double")) / ratio).cast("int")
    members = members.withColumn("size", size)
    groups = (
        members.groupBy("centre", "size")
        .agg(F.count("*").alias("m"), F.sum("n").alias("elements"))
        .groupBy("centre")
        .agg(
            F.map_from_entries(F.collect_list(F.struct("size", "m"))).alias("sets"),
            F.map_from_entries(
                F.collect_list(
                    F.struct("size", F.ceil(F.col("elements") * 2 / group_elements).cast("int"))
                )
            ).alias("parts"),
            F.sum("m").alias("m"),
            F.sum("elements").alias("elements"),
        )
        .where("m > 1")
    )
    near = sum(
        F.coalesce(F.try_element_at("sets", F.col("size") + i), F.lit(0)) for i in (-1, 0, 1)
    )
    members = materialise(members.join(groups, "centre").where(near > 1), "jaccard-members")
    small = members.where(F.col("elements") <= group_elements).select(
        "doc_id", "fp", F.xxhash64("centre").alias("task"), "n"
    )
    part = F.pmod(F.xxhash64("doc_id", "fp"), F.element_at("parts", F.col("size"))).cast("int")
    dealt = members.where(F.col("elements") > group_elements).select(
        "centre", "size", part.alias("part"), "doc_id", "fp", "n"
    )
    return small, materialise(dealt, "jaccard-dealt")


def _block_key(*more: str) -> Column:
    return F.xxhash64("centre", "size", "part", *more)


def _largest(dealt: DataFrame, links: DataFrame, keys: list[str]) -> DataFrame:
    """``dealt`` and whether a set is in the component that most sets of its ``keys`` are in."""
    parts = connected_components(links)
    known = dealt.join(parts, dealt["doc_id"] == parts["node"], "left").select(
        *dealt.columns, F.coalesce("component", "doc_id").alias("component")
    )
    known = materialise(known, "jaccard-known")
    most = Window.partitionBy(*keys).orderBy(F.desc("m"), "component")
    largest = (
        known.groupBy(*keys, "component")
        .agg(F.count("*").alias("m"))
        .withColumn("place", F.row_number().over(most))
        .where("place = 1")
        .select(*keys, F.col("component").alias("largest"))
    )
    return known.join(largest, keys).withColumn("in_largest", F.expr("component = largest"))


def _across(dealt: DataFrame, rest: DataFrame, group_elements: int) -> DataFrame:
    """Searches of each block with the sets of ``rest`` that can link with its sets."""
    sizes = rest.groupBy("centre", "size").agg(
        F.ceil(F.sum("n") * 2 / group_elements).cast("int").alias("cuts")
    )
    blocks = dealt.select("centre", "size", "part").distinct()
    near = F.explode(F.array(*[F.col("size") + i for i in (-1, 0, 1)])).alias("size")
    # A block meets each cut of the rest of its own size class and of the neighbouring ones.
    meets = (
        sizes.select("centre", F.col("size").alias("of"), "cuts", near)
        .join(blocks, ["centre", "size"])
        .select("centre", "size", "part", "of", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut"), "cuts")
    )
    meets = materialise(meets, "jaccard-meets")
    task = _block_key("of", "cut").alias("task")
    own = dealt.join(meets, ["centre", "size", "part"]).select("doc_id", "fp", task, "n")
    guests = rest.select("centre", F.col("size").alias("of"), "doc_id", "fp", "n").join(
        meets, ["centre", "of"]
    )
    its = F.pmod(F.xxhash64("fp", "doc_id"), F.col("cuts")) == F.col("cut")
    return own.unionByName(guests.where(its).select("doc_id", "fp", task, "n")).distinct()


def _routed(base: DataFrame, searches: DataFrame, group_elements: int) -> DataFrame:
    """The texts of all searches, by shard."""
    total = searches.agg(F.sum("n")).first()[0] or 0
    shards = max(64, -(-total // group_elements))
    tasks = searches.groupBy("doc_id").agg(F.collect_set(F.struct("fp", "task")).alias("tasks"))
    tasks = materialise(tasks, "jaccard-tasks")
    # Few documents are searched. What is broadcast has at most _SLOTS rows at any input; a document
    # that only shares a slot with a searched one is left to the join.
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(_SLOTS)).alias("slot")
    slots = F.broadcast(tasks.select(slot).distinct())
    return (
        base.where("doc_id is not null")
        .withColumn("slot", slot)
        .join(slots, "slot", "left_semi")
        .join(tasks, "doc_id")
        .select("doc_id", "text", F.explode("tasks").alias("t"))
        .select("doc_id", "text", "t.fp", "t.task", F.pmod("t.task", F.lit(shards)).alias("shard"))
    )


def _sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The set of each row of a chunk, sorted, one after the other; where each begins."""
    h = words.digests(LOWER)
    count = words.count()
    per_row = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    offsets = np.concatenate([[0], np.cumsum(per_row)])
    rows = np.repeat(np.arange(len(count)), per_row)
    within = np.arange(len(rows)) - offsets[rows]
    values = np.zeros(len(rows), U64)
    full = count[rows] >= n
    values[full] = grams(h, n)[words.first[rows[full]] + within[full]]
    for m in range(1, n):
        few = np.flatnonzero(count == m)
        if len(few):
            values[offsets[few]] = mix(grams(h, m)[words.first[few]] + U64(m))
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if hi - lo > 1:
            values[lo:hi].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    size = np.bincount(rows[keep], minlength=len(count))
    return values[keep], np.concatenate([[0], np.cumsum(size)])


def _fingerprints(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set, whatever the order of its elements."""
    out = []
    for seed in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
        total = np.concatenate([[U64(0)], np.cumsum(mix(values ^ U64(seed)), dtype=U64)])
        out.append(mix(total[offsets[1:]] - total[offsets[:-1]]))
    return out[0], out[1]


def _count(batches: Iterator[pa.RecordBatch], n: int):
    """Rows of kind 0: id, set size, fingerprint. Of kind 1: element, sets, smallest fingerprint."""
    names = ["kind", "a", "b", "c", "d"]
    held: list[tuple[np.ndarray, np.ndarray]] = []
    known: set[int] = set()

    def round_end():
        values = np.concatenate([v for v, _ in held])
        owner = np.concatenate([f for _, f in held])
        held.clear()
        known.clear()
        order = np.argsort(values)
        values, owner = values[order], owner[order]
        at = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        sets = np.diff(np.append(at, len(values)))
        many = np.flatnonzero(sets >= _LOCAL)
        least = np.minimum.reduceat(owner, at)[many]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.ones(len(many), np.int32)),
                int64(values[at[many]]),
                pa.array(sets[many].astype(np.int64)),
                int64(least),
                pa.array(np.zeros(len(many), np.int64)),
            ],
            names,
        )

    for batch in batches:
        ids = batch.column("doc_id")
        for words in chunks(text_column(batch, "text")):
            values, offsets = _sets(words, n)
            fp, fp2 = _fingerprints(values, offsets)
            size = np.diff(offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.zeros(len(size), np.int32)),
                    ids.slice(words.lo, words.hi - words.lo),
                    pa.array(size.astype(np.int64)),
                    int64(fp),
                    int64(fp2),
                ],
                names,
            )
            new = _first_seen(fp, known)
            held.append((values[np.repeat(new, size)], np.repeat(fp, size)[np.repeat(new, size)]))
            if sum(len(v) for v, _ in held) >= _ROUND:
                yield round_end()
    if sum(len(v) for v, _ in held):
        yield round_end()


def _first_seen(fp: np.ndarray, known: set[int]) -> np.ndarray:
    new = np.zeros(len(fp), bool)
    for i, value in enumerate(fp.tolist()):
        if value not in known:
            known.add(value)
            new[i] = True
    return new


def _postings(
    batches: Iterator[pa.RecordBatch],
    n: int,
    p: int,
    q: int,
    buckets: int,
    long_lists: tuple[np.ndarray, np.ndarray],
):
    """The leading elements of each set, packed by bucket, and the centres of long lists."""
    element, centre = long_lists
    known: set[int] = set()
    held: list[list[np.ndarray]] = [[], [], [], []]

    def flush():
        value, member, sure_member, sure_centre = (np.concatenate(x) for x in held)
        for x in held:
            x.clear()
        pairs = _pairs(sure_member, sure_centre, np.ones(len(sure_member), U64))
        to = (value % U64(buckets)).astype(np.int64)
        also = (pairs[:, 0] % U64(buckets)).astype(np.int64)
        order, order2 = np.argsort(to, kind="stable"), np.argsort(also, kind="stable")
        value, member, pairs = value[order], member[order], pairs[order2]
        edge = np.searchsorted(to[order], np.arange(buckets + 1))
        edge2 = np.searchsorted(also[order2], np.arange(buckets + 1))
        full = np.flatnonzero((np.diff(edge) > 0) | (np.diff(edge2) > 0))
        cut = [(edge[b], edge[b + 1], edge2[b], edge2[b + 1]) for b in full]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(full.astype(np.int32)),
                pa.array([value[a:b].tobytes() for a, b, _, _ in cut], pa.binary()),
                pa.array([member[a:b].tobytes() for a, b, _, _ in cut], pa.binary()),
                pa.array([pairs[c:d, 0].tobytes() for _, _, c, d in cut], pa.binary()),
                pa.array([pairs[c:d, 1].tobytes() for _, _, c, d in cut], pa.binary()),
                pa.array([pairs[c:d, 2].tobytes() for _, _, c, d in cut], pa.binary()),
            ],
            ["bucket", "element", "member", "sure_member", "sure_centre", "sure_lists"],
        )

    for batch in batches:
        for words in chunks(text_column(batch, "text")):
            values, offsets = _sets(words, n)
            fp, _ = _fingerprints(values, offsets)
            size = np.diff(offsets)
            if len(element):
                at = np.minimum(np.searchsorted(element, values), len(element) - 1)
                is_long = element[at] == values
            else:
                at, is_long = np.zeros(len(values), np.int64), np.zeros(len(values), bool)
            rows = np.repeat(np.arange(len(size)), size)
            # A set's place in the order: its short elements by hash, then its long ones.
            shorts = np.cumsum(~is_long) - ~is_long
            longs = np.cumsum(is_long) - is_long
            begin = offsets[:-1][rows]
            n_short = np.bincount(rows[~is_long], minlength=len(size))[rows]
            edge = np.minimum(begin, max(len(values) - 1, 0))
            place = np.where(is_long, n_short + longs - longs[edge], shorts - shorts[edge])
            overlap = (p * size + q - 1) // q
            lead = size - overlap + (overlap + _EXTRA - 1) // _EXTRA
            new = _first_seen(fp, known)
            take = (place < lead[rows]) & new[rows]
            here, far = take & ~is_long, take & is_long
            held[0].append(values[here])
            held[1].append(fp[rows[here]])
            held[2].append(fp[rows[far]])
            held[3].append(centre[at[far]] if len(element) else np.zeros(0, U64))
            if sum(map(len, held[0])) + sum(map(len, held[2])) >= 1_000_000:
                yield flush()
    if sum(map(len, held[0])) + sum(map(len, held[2])):
        yield flush()


def _lists(table: pa.Table) -> pa.Table:
    """The inverted lists of a bucket: each set with the centres of its lists."""

    def whole(name: str) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(name).to_pylist()), U64)

    value, member = whole("element"), whole("member")
    order = np.lexsort((member, value))
    value, member = value[order], member[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (member[1:] != member[:-1])
    value, member = value[new], member[new]
    first = np.ones(len(value), bool)
    first[1:] = value[1:] != value[:-1]
    at = np.flatnonzero(first)
    length = np.diff(np.append(at, len(value)))
    shared = np.repeat(length > 1, length)
    centre = np.repeat(member[at], length)[shared]
    listed = np.stack([member[shared], centre, np.ones(len(centre), U64)], axis=1)
    sure = np.stack([whole("sure_member"), whole("sure_centre"), whole("sure_lists")], axis=1)
    pairs = _pairs(*np.concatenate([listed, sure]).T)
    return pa.table(
        {"fp": int64(pairs[:, 0]), "centre": int64(pairs[:, 1]), "lists": int64(pairs[:, 2])}
    )


def _pairs(member: np.ndarray, centre: np.ndarray, lists: np.ndarray) -> np.ndarray:
    """Each (member, centre) once, with the sum of its lists."""
    order = np.lexsort((centre, member))
    member, centre, lists = member[order], centre[order], lists[order]
    new = np.ones(len(member), bool)
    new[1:] = (member[1:] != member[:-1]) | (centre[1:] != centre[:-1])
    at = np.flatnonzero(new)
    total = np.add.reduceat(lists, at) if len(at) else lists
    return np.stack([member[at], centre[at], total], axis=1)


def _search(table: pa.Table, n: int, p: int, q: int) -> pa.Table:
    """All searches of a shard; links (of documents) that join parts of a group."""
    ids = table.column("doc_id").to_numpy()
    want = table.column("fp").to_numpy().view(U64)
    task = table.column("task").to_numpy()
    sets: list[np.ndarray | None] = [None] * len(ids)
    for words in chunks(text_column(table, "text")):
        values, offsets = _sets(words, n)
        fp, _ = _fingerprints(values, offsets)
        for i in np.flatnonzero(fp == want[words.lo : words.hi]).tolist():
            sets[words.lo + i] = values[offsets[i] : offsets[i + 1]]
    u, v = [], []
    order = np.argsort(task, kind="stable")
    cuts = np.flatnonzero(np.diff(task[order])) + 1
    for rows in np.split(order, cuts):
        rows = [i for i in rows.tolist() if sets[i] is not None]
        rows.sort(key=lambda i: (len(sets[i]), ids[i]))
        for a, b in _links([sets[i] for i in rows], p, q):
            u.append(ids[rows[a]])
            v.append(ids[rows[b]])
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _links(sets: list[np.ndarray], p: int, q: int) -> Iterator[tuple[int, int]]:
    """Links between sets (in order of size) that join two parts; the rest follow from them."""
    m = len(sets)
    if m < 2:
        return
    root = list(range(m))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    size = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(m), size)
    offsets = np.concatenate([[0], np.cumsum(size)])
    order = np.argsort(values, kind="stable")  # owners ascend within a list
    listed = values[order]
    first = np.concatenate([[True], listed[1:] != listed[:-1]])
    begin = np.flatnonzero(first)
    number = np.cumsum(first) - 1
    rank = np.empty(len(values), np.int64)  # of an element's own entry in all lists
    rank[order] = np.arange(len(values))
    owners = owner[order]
    # Entries before its own: the smaller sets that share the element.
    before = rank - begin[number[rank]]
    for x in range(1, m):
        own = slice(offsets[x], offsets[x + 1])
        length = before[own]
        some = np.flatnonzero(length)
        need = -(-p * int(size[x]) // q)
        if len(some) < need:
            continue
        some = some[np.argsort(length[some], kind="stable")]
        longest = int(length[some[-1]])
        aside = min(need - 1, int(need / (_MU * np.log2(longest + 1) + 1)))
        short, long = some[: len(some) - aside], some[len(some) - aside :]
        ends = rank[own][short]
        counts = length[short]
        total = int(counts.sum())
        step = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
        hits = np.bincount(owners[np.repeat(ends - counts, counts) + step], minlength=x)
        probe = sets[x][np.sort(long)]
        for y in np.flatnonzero(hits >= need - aside).tolist():
            if find(x) == find(y):
                continue
            bound = p * int(size[x] + size[y])
            if (p + q) * (int(hits[y]) + aside) < bound:
                continue
            at = np.minimum(np.searchsorted(sets[y], probe), size[y] - 1)
            shared = int(hits[y]) + int((sets[y][at] == probe).sum())
            if (p + q) * shared >= bound:
                root[find(x)] = find(y)
                yield y, x
