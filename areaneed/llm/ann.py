"""Nearest neighbours by a hierarchical k-means tree with best-bin-first search.

1. Equal vectors go on as one; of each the smallest ``k + 1`` ids are kept, which is all that any answer
   can name.
2. The tree is fitted on a bounded sample (``sample`` distinct vectors, taken by hash) and has at most
   ``leaves`` leaves; every vector is then put into its leaf. The tree is the one thing that
   is broadcast; its size follows from ``leaves``.
3. A priority queue gives a query its leaves, the open branch with the best outlook first: the inner
   product with the centroid and twice what the branch spreads along one direction. The
   number of leaves is calibrated: for ``probe`` queries the exact answer over all vectors is computed
   in one scan, and visits are widened until all but ``spared`` of these queries each find
   the part ``recall`` of their neighbours. A query goes on until its leaves also hold
   ``k + 1`` distinct vectors, so it always finds ``k`` where there are as many.
4. Leaves are put together in ``_GROUPS`` neighbouring groups of about the same size. A query travels
   once to each group it visits, with the list of its leaves there, so what is shuffled grows
   with vectors and queries and not with visits. Groups with many vectors or queries are cut into
   blocks, so a task multiplies matrices of a bounded size.
"""

import heapq
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areaneed.sources.scratch import materialise

_GROUPS = 16
_BLOCK_BYTES = 16 << 20  # of the vectors, or the queries, of a block
_SCORES = 4_000_000  # held at once


class Tree:
    """Centroids of a k-means hierarchy; node 0 is the root, ``leaf`` numbers the leaves."""

    def __init__(self, points: np.ndarray, leaves: int, branch: int, seed: int):
        self.children: list[list[int]] = [[]]
        self.leaf: list[int] = [0]
        self.n_leaves = 0
        centroids = [points.mean(axis=0) if len(points) else np.zeros(points.shape[1])]
        spread = [_spread(points, centroids[0])]
        most = max(1, -(-len(points) // max(1, leaves)))
        rng = np.random.default_rng(seed)
        todo = [(0, points)]
        while todo:
            node, own = todo.pop()
            parts = _kmeans(own, min(branch, -(-len(own) // most)), rng) if len(own) > most else []
            if len(parts) < 2:
                self.leaf[node] = self.n_leaves
                self.n_leaves += 1
                continue
            for centre, rows in parts:
                child = len(centroids)
                centroids.append(centre)
                spread.append(_spread(own[rows], centre))
                self.children.append([])
                self.leaf.append(-1)
                self.children[node].append(child)
                todo.append((child, own[rows]))
        self.centroids = np.array(centroids)
        self.spread = np.array(spread)

    def outlook(self, queries: np.ndarray) -> np.ndarray:
        """What each node promises each query."""
        length = np.sqrt((queries * queries).sum(axis=1))
        return queries @ self.centroids.T + 2 * length[:, None] * self.spread

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: at every node the nearest child."""
        out = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            children = self.children[node]
            if not children:
                out[rows] = self.leaf[node]
                continue
            c = self.centroids[children]
            nearest = np.argmin((c * c).sum(axis=1) - 2 * x[rows] @ c.T, axis=1)
            for j, child in enumerate(children):
                if len(own := rows[nearest == j]):
                    todo.append((child, own))
        return out

    def best_first(self, outlook: np.ndarray, visits: int, size: np.ndarray, least: int):
        """The first leaves that a queue of open branches gives: ``visits`` of them, and more until
        their ``size`` adds up to ``least``."""
        queue, found, held = [(0.0, 0)], [], 0
        while queue and (len(found) < visits or held < least):
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                found.append(self.leaf[node])
                held += int(size[self.leaf[node]])
            for child in self.children[node]:
                heapq.heappush(queue, (-outlook[child], child))
        return found


def _spread(points: np.ndarray, centre: np.ndarray) -> float:
    """Of points around their centre along one direction, on average."""
    return float(np.sqrt(((points - centre) ** 2).mean())) if points.size else 0.0


def _kmeans(points: np.ndarray, k: int, rng) -> list[tuple[np.ndarray, np.ndarray]]:
    centres = points[rng.choice(len(points), k, replace=False)]
    for _ in range(8):
        own = np.argmin((centres * centres).sum(axis=1) - 2 * points @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        n = np.bincount(own, minlength=k)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    own = np.argmin((centres * centres).sum(axis=1) - 2 * points @ centres.T, axis=1)
    return [(centres[j], np.flatnonzero(own == j)) for j in range(k) if (own == j).any()]


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components finite."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")),
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def tree_neighbours(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    recall: float = 0.95,
    spared: float = 0.03,
    sample: int = 20_000,
    leaves: int = 512,
    leaf_vectors: int = 128,
    probe: int = 256,
    branch: int = 8,
    seed: int = 7,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the nearest found of each query.

    Queries are the rows where ``is_query`` holds; the candidates of a query are all other rows. Nearness is
    the inner product in double precision, larger first, then the smaller id.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do those
    whose length is not the most frequent one (the larger of equally frequent ones). Rows with a
    null id take no part; rows that repeat an id and vector are one row, and of
    an id with several vectors each counts. Other columns are not read, but by ``is_query``. An empty
    table, or one without queries, gives an empty result; with fewer candidates than ``k`` a query
    gets them all.
    """
    spark = vectors.sparkSession
    rows = (
        vectors.select(
            F.col(f"`{id_col}`").cast("long").alias("id"),
            F.col(f"`{vector_col}`").cast("array<double>").alias("v"),
            F.coalesce(is_query, F.lit(False)).alias("q"),
        )
        .where(usable(F.col("v")) & F.col("id").isNotNull())
        .groupBy("id", "v")
        .agg(F.max("q").alias("q"))
    )
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n"))
    first = sizes.first()
    schema = "query_id long, rank int, vec_id long, score double"
    if first is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("v") == first["n"])
    distinct = materialise(
        rows.groupBy("v").agg(F.min("id").alias("rep"), F.max("q").alias("q")), "vectors"
    )
    # A third of all rows may be one vector: the limit works before the shuffle.
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    named = rows.withColumn("place", place).where(F.col("place") <= k + 1)
    named = named.join(distinct.select("v", "rep"), "v").select("rep", "id")

    n = distinct.count()
    rep_hash = F.xxhash64("rep", F.lit(seed))
    taken = distinct.orderBy(rep_hash, "rep").limit(sample).select("v").toPandas()["v"]
    points = np.array(taken.tolist())
    leaves = min(-(-n // leaf_vectors), leaves, max(1, len(points) // 4))
    tree = Tree(points, leaves, branch, seed)
    placed = materialise(
        distinct.mapInArrow(partial(_place, tree=tree), "rep long, v array<double>, q boolean, leaf int"),
        "leaves",
    )
    # One row a leaf.
    size = np.zeros(tree.n_leaves, np.int64)
    for row in placed.groupBy("leaf").count().collect():
        size[row["leaf"]] = row["count"]
    visits = _calibrated(placed, tree, size, k, recall, spared, probe, rep_hash)

    # Neighbouring leaves are numbered one after the other.
    group = (np.cumsum(size) - size) * _GROUPS // max(1, int(size.sum()))
    asked = materialise(
        placed.where("q")
        .select("rep", "v")
        .mapInArrow(
            partial(_visit, tree=tree, visits=visits, size=size, least=k + 1, group=group),
            "rep long, v array<double>, bin int, leaves array<int>",
        ),
        "visits",
    )
    bins = F.element_at(F.array(*[F.lit(int(x)) for x in group]), F.col("leaf") + 1)
    placed = placed.withColumn("bin", bins)
    block = max(1024, _BLOCK_BYTES // (8 * max(1, first["n"])))
    blocks = lambda df, name: df.groupBy("bin").agg(
        F.ceil(F.count("*") / block).cast("int").alias(name)
    )
    cut = blocks(placed, "parts").join(blocks(asked, "asks"), "bin")
    every = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    own = lambda name: F.pmod(F.xxhash64("rep"), F.col(name)).cast("int")
    left = (
        asked.join(cut, "bin")
        .withColumn("ask", own("asks"))
        .select("bin", every("parts").alias("part"), "ask", "rep", "v", "leaves")
    )
    right = (
        placed.join(cut, "bin")
        .withColumn("part", own("parts"))
        .select("bin", "part", every("asks").alias("ask"), "rep", "v", "leaf")
    )
    most = k + 1

    def score(queries: pa.Table, points: pa.Table) -> pa.Table:
        return _score(queries, points, most)

    keys = ["bin", "part", "ask"]
    scored = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        score, "query long, rep long, score double"
    )
    top = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    best = scored.withColumn("place", F.row_number().over(top)).where(F.col("place") <= most)
    # Ids of the best vectors, best first.
    by_id = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    answers = (
        best.join(named, "rep")
        .withColumn("place", F.row_number().over(by_id))
        .where(F.col("place") <= most)
        .groupBy("query")
        .agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("found"))
    )
    asking = rows.where("q").join(distinct.select("v", F.col("rep").alias("query")), "v")
    out = asking.select("id", "query").join(answers, "query").select(
        F.col("id").alias("query_id"),
        F.posexplode(
            F.slice(F.filter("found", lambda x: x["id"] != F.col("id")), 1, k)
        ).alias("at", "x"),
    )
    return out.select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("x.id").alias("vec_id"),
        F.col("x.score").alias("score"),
    )


def exact_neighbours(
    placed: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int
) -> DataFrame:
    """(query, rep, leaf): the ``k`` nearest of each of a bounded set of queries, by one scan."""
    near = placed.mapInArrow(
        partial(_scan, ids=ids, queries=queries, k=k), "query long, rep long, leaf int, score double"
    )
    top = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    return near.withColumn("place", F.row_number().over(top)).where(F.col("place") <= k)


def _calibrated(
    placed: DataFrame,
    tree: Tree,
    size: np.ndarray,
    k: int,
    recall: float,
    spared: float,
    probe: int,
    rep_hash: Column,
) -> int:
    """Leaves to visit so that all but ``spared`` of ``probe`` queries find the part ``recall``."""
    some = placed.where("q").orderBy(rep_hash, "rep").limit(probe).select("rep", "v").toPandas()
    if some.empty:
        return 1
    ids, queries = some["rep"].to_numpy(np.int64), np.array(some["v"].tolist())
    truth = exact_neighbours(placed, ids, queries, k + 1).select("query", "leaf").toPandas()
    outlook = tree.outlook(queries)
    needed = []
    place = {query: i for i, query in enumerate(ids.tolist())}
    for query, leaves in truth.groupby("query")["leaf"]:
        order = tree.best_first(outlook[place[query]], tree.n_leaves, size, 0)
        turn = np.empty(tree.n_leaves, np.int64)
        turn[order] = np.arange(1, tree.n_leaves + 1)
        turns = np.sort(turn[leaves.to_numpy()])
        needed.append(turns[max(0, int(np.ceil(recall * len(turns))) - 1)])
    needed = np.sort(needed)
    return int(needed[max(0, int(np.ceil((1 - spared) * len(needed))) - 1)])


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _place(batches: Iterator[pa.RecordBatch], tree: Tree):
    for batch in batches:
        if len(batch):
            leaf = pa.array(tree.place(_matrix(batch.column("v"), len(batch))))
            columns = [batch.column(x) for x in ("rep", "v", "q")]
            yield pa.RecordBatch.from_arrays([*columns, leaf], ["rep", "v", "q", "leaf"])


def _visit(
    batches: Iterator[pa.RecordBatch],
    tree: Tree,
    visits: int,
    size: np.ndarray,
    least: int,
    group: np.ndarray,
):
    """One row a query and group of leaves, with the leaves to visit there."""
    for batch in batches:
        # A part of a batch at a time: each of its rows is written once a group.
        for lo in range(0, len(batch), 256):
            part = batch.slice(lo, 256)
            rows, bins, leaves = [], [], []
            for i, x in enumerate(tree.outlook(_matrix(part.column("v"), len(part)))):
                own = np.sort(tree.best_first(x, visits, size, least))
                for found in np.split(own, np.flatnonzero(np.diff(group[own])) + 1):
                    rows.append(i)
                    bins.append(group[found[0]])
                    leaves.append(found.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("rep").take(pa.array(rows)),
                    part.column("v").take(pa.array(rows)),
                    pa.array(bins, pa.int32()),
                    pa.array(leaves, pa.list_(pa.int32())),
                ],
                ["rep", "v", "bin", "leaves"],
            )


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` largest scores of each row, ties to the smaller id."""
    if scores.shape[1] > k:
        least = np.partition(scores, -k, axis=1)[:, -k]
        rows, columns = np.nonzero(scores >= least[:, None])
    else:
        rows, columns = np.nonzero(np.ones_like(scores, bool))
    order = np.lexsort((ids[columns], -scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    first = np.searchsorted(rows, np.arange(len(scores)))
    keep = np.arange(len(rows)) - first[rows] < k
    return rows[keep], columns[keep]


def _score(queries: pa.Table, points: pa.Table, k: int) -> pa.Table:
    """The ``k`` best points of each query among the leaves it visits."""
    if not len(queries) or not len(points):
        empty = pa.array([], pa.int64())
        return pa.table({"query": empty, "rep": empty, "score": pa.array([], pa.float64())})
    points = points.sort_by("leaf")
    own, ids = queries.column("rep").to_numpy(), points.column("rep").to_numpy()
    x, y = _matrix(queries.column("v"), len(own)), _matrix(points.column("v"), len(ids))
    here, begin = np.unique(points.column("leaf").to_numpy(), return_index=True)
    ends = [*begin[1:].tolist(), len(ids)]
    lists = queries.column("leaves").combine_chunks()
    wanted = lists.flatten().to_numpy(zero_copy_only=False)
    asker = np.repeat(np.arange(len(own)), lists.value_lengths().to_numpy(zero_copy_only=False))
    query, rep, score = [], [], []
    step = max(1, _SCORES // len(ids))
    for lo in range(0, len(own), step):
        scores = np.full((min(step, len(own) - lo), len(ids)), -np.inf)
        some = (asker >= lo) & (asker < lo + step)
        for leaf, a, b in zip(here.tolist(), begin.tolist(), ends, strict=True):
            rows = asker[some & (wanted == leaf)] - lo
            scores[rows, a:b] = x[lo + rows] @ y[a:b].T
        rows, columns = _best(scores, ids, k)
        seen = scores[rows, columns] > -np.inf
        rows, columns = rows[seen], columns[seen]
        query.append(own[lo + rows])
        rep.append(ids[columns])
        score.append(scores[rows, columns])
    return pa.table(
        {
            "query": np.concatenate(query),
            "rep": np.concatenate(rep),
            "score": np.concatenate(score),
        }
    )


def _scan(batches: Iterator[pa.RecordBatch], ids: np.ndarray, queries: np.ndarray, k: int):
    for batch in batches:
        if not len(batch):
            continue
        reps = batch.column("rep").to_numpy()
        scores = queries @ _matrix(batch.column("v"), len(batch)).T
        rows, columns = _best(scores, reps, k)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids[rows]),
                pa.array(reps[columns]),
                batch.column("leaf").take(pa.array(columns)),
                pa.array(scores[rows, columns]),
            ],
            ["query", "rep", "leaf", "score"],
        )
