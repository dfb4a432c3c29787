"""Approximate nearest neighbours with a forest of random-projection trees.

Vectors are ranked by inner product. For the trees each gets one more component that makes all norms equal
(the largest), so that a large inner product is a small angle; queries get a zero there.

The trees' splits are fitted on a sample of at most ``SAMPLE`` distinct vectors, every vector is indexed: it
is routed down each tree to a leaf. A query searches all trees through one shared priority queue of
branches, nearest boundary first, and so takes the most promising leaves of the whole forest. How many it takes
is fitted to the table: ``FITTED`` queries are answered by brute force, and the leaves it takes to find ``RECALL``
of their neighbours are what every query visits. Queries and
vectors meet by leaf; candidates are ranked there exactly, in double precision, and a leaf hands on its
best ``k`` a query.

Equal vectors fall into the same leaves of all trees, however many there are. They go in as one vector with
its ``k + 1`` smallest ids: with ties going to smaller ids no other copy can be among ``k`` results. A leaf of
many vectors is dealt into parts of at most ``PART_ROWS``.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemart.llm.tables import settled

SAMPLE = 20_000  # distinct vectors the splits are fitted on
TREES = 12
LEAF_ROWS = 256  # about so many sampled vectors a leaf
PROBES = 200  # leaves a query visits in the whole forest at least
RECALL = 0.95  # of the fitted queries' neighbours are in the leaves visited
FITTED = 256  # queries answered by brute force
VISITS = 50_000  # are handed on together
PART_ROWS = 20_000
SEED = 7


def usable(vector: Column) -> Column:
    """The vector in doubles; null if it is null, empty, zero or has a null or non-finite component."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    odd = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~odd & F.exists(doubles, lambda x: x != 0), doubles)


class Forest:
    """Trees as arrays: a node's normal and offset, and its children; a child below 0 is leaf ``-1 - child``."""

    def __init__(self, sample: np.ndarray, longest: float, trees: int, leaf_rows: int):
        self.longest = longest
        points = self.lifted(sample)
        random = np.random.default_rng(SEED)
        self.normals: list[np.ndarray] = []
        self.offsets: list[float] = []
        self.children: list[list[int]] = []
        self.roots: list[int] = []
        self.leaves = 0
        for _ in range(trees):
            self.roots.append(self._grow(points, np.arange(len(points)), leaf_rows, random))
        self.normals = np.array(self.normals).reshape(len(self.offsets), points.shape[1])
        self.offsets = np.array(self.offsets)

    def _grow(self, points: np.ndarray, rows: np.ndarray, leaf_rows: int, random) -> int:
        if len(rows) > leaf_rows:
            # The plane between two drawn points, moved to the median: both sides get half.
            a, b = points[random.choice(rows, 2, replace=False)]
            normal = (a - b) / max(np.linalg.norm(a - b), 1e-12)
            along = points[rows] @ normal
            offset = float(np.median(along))
            right = along > offset
            if 0 < right.sum() < len(rows):
                node = len(self.offsets)
                self.normals.append(normal)
                self.offsets.append(offset)
                self.children.append([0, 0])
                self.children[node] = [self._grow(points, rows[~right], leaf_rows, random), self._grow(points, rows[right], leaf_rows, random)]
                return node
        self.leaves += 1
        return -self.leaves

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """Scaled to the longest norm, with the component that completes it; longer ones get 0 there."""
        unit = vectors / self.longest
        rest = np.sqrt(np.maximum(1.0 - (unit * unit).sum(axis=1), 0.0))
        return np.concatenate([unit, rest[:, None]], axis=1)

    def leaves_of(self, vectors: np.ndarray) -> np.ndarray:
        """Each vector's leaf in every tree."""
        points = self.lifted(vectors)
        out = np.empty((len(points), len(self.roots)), np.int64)
        children = np.array(self.children).reshape(-1, 2)
        for t, root in enumerate(self.roots):
            node = np.full(len(points), root)
            inner = np.flatnonzero(node >= 0)
            while len(inner):
                at = node[inner]
                right = (points[inner] * self.normals[at]).sum(axis=1) > self.offsets[at]
                node[inner] = children[at, right.astype(int)]
                inner = inner[node[inner] >= 0]
            out[:, t] = -1 - node
        return out

    def search(self, vectors: np.ndarray, probes: int) -> Iterator[list[int]]:
        """For each query the leaves it visits, from one queue of branches over all trees."""
        scale = np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-300)
        points = np.concatenate([vectors / scale, np.zeros((len(vectors), 1))], axis=1)
        for start in range(0, len(points), 512):
            margins = points[start : start + 512] @ self.normals.T - self.offsets if len(self.offsets) else np.zeros((len(points), 0))
            for row in margins:
                queue = [(-np.inf, root) for root in self.roots]
                heapq.heapify(queue)
                found: list[int] = []
                while queue and len(found) < probes:
                    far, node = heapq.heappop(queue)
                    while node >= 0:
                        margin = row[node]
                        near = int(margin > 0)
                        heapq.heappush(queue, (max(far, abs(margin)), self.children[node][1 - near]))
                        node = self.children[node][near]
                    found.append(-1 - node)
                yield found


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _route_task(shared, width: int):
    """Each vector once for every tree, under its leaf."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            leaves = shared.value.leaves_of(_matrix(batch.column("v"), width))
            for t in range(leaves.shape[1]):
                yield pa.RecordBatch.from_arrays([pa.array(leaves[:, t]), batch.column("ids"), batch.column("v")], names=["leaf", "ids", "v"])

    return task


def _search_task(shared, width: int, probes: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, min(256, VISITS // probes))
            for start in range(0, len(batch), step):
                part = batch.slice(start, step)
                visits = list(shared.value.search(_matrix(part.column("v"), width), probes))
                times = [len(x) for x in visits]
                row = pa.array(np.repeat(np.arange(len(part)), times))
                leaf = pa.array(np.concatenate([np.array(x, np.int64) for x in visits]))
                yield pa.RecordBatch.from_arrays([leaf, part.column("query_id").take(row), part.column("v").take(row)], names=["leaf", "query_id", "v"])

    return task


def _rank_task(width: int, k: int):
    """A part of a leaf with its visitors: each visitor's best, ranked by exact inner products."""

    def task(key, queries: pa.Table, members: pa.Table) -> pa.Table:
        found: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(queries) and len(members):
            rows = _matrix(members.column("v").combine_chunks(), width)
            lists = members.column("ids").combine_chunks()
            ends = lists.offsets.to_numpy()
            ids = lists.values.to_numpy()
            first = ids[ends[:-1]]
            asked = queries.column("query_id").to_numpy()
            points = _matrix(queries.column("v").combine_chunks(), width)
            for start in range(0, len(asked), 256):
                scores = points[start : start + 256] @ rows.T
                for own, row in zip(asked[start : start + 256], scores, strict=True):
                    # k + 1 vectors, as one of them may be the query's own; then ties to smaller ids.
                    least = np.partition(row, len(row) - k - 1)[len(row) - k - 1] if len(row) > k + 1 else -np.inf
                    near = np.flatnonzero(row >= least)
                    near = near[np.lexsort((first[near], -row[near]))][: 2 * k + 2] if len(near) > 2 * k + 2 else near
                    of = np.repeat(near, ends[near + 1] - ends[near])
                    candidates = np.concatenate([ids[ends[r] : ends[r + 1]] for r in near])
                    value = row[of]
                    other = candidates != own
                    candidates, value = candidates[other], value[other]
                    best = np.lexsort((candidates, -value))[:k]
                    found.append((np.full(len(best), own), candidates[best], value[best]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})

    return task


def _exact_task(shared, asked, width: int, k: int):
    """Of the task's vectors each fitted query's best by exact inner products, with their leaves."""

    def best_of(parts: list[tuple]) -> tuple:
        ids, scores, leaves = (np.concatenate(c) for c in zip(*parts, strict=True))
        best = np.lexsort((ids, -scores))[:k]
        return ids[best], scores[best], leaves[best]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, points = asked.value
        found: list[tuple | None] = [None] * len(own)
        for batch in batches:
            if not len(batch):
                continue
            rows = _matrix(batch.column("v"), width)
            lists = batch.column("ids").combine_chunks() if isinstance(batch.column("ids"), pa.ChunkedArray) else batch.column("ids")
            starts, ids = lists.offsets.to_numpy(), lists.values.to_numpy()
            leaves = shared.value.leaves_of(rows)
            for q, row in enumerate(points @ rows.T):
                least = np.partition(row, len(row) - k - 1)[len(row) - k - 1] if len(row) > k + 1 else -np.inf
                near = np.flatnonzero(row >= least)
                of = np.repeat(near, starts[near + 1] - starts[near])
                candidates = np.concatenate([ids[starts[r] : starts[r + 1]] for r in near])
                other = candidates != own[q]
                new = (candidates[other], row[of][other], leaves[of][other])
                found[q] = best_of([new] if found[q] is None else [found[q], new])
        for q, one in enumerate(found):
            if one is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(one[0]), q)), pa.array(one[0]), pa.array(one[1]), pa.array(list(one[2]), pa.list_(pa.int64()))], names=["q", "vec_id", "score", "leaves"])

    return task


def _needed_task(shared, asked, probes: int):
    """For each true neighbour of a fitted query, how many leaves the query visits until it finds it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q, lists in zip(batch.column("q").to_pylist(), batch.column("leaves").to_pylist(), strict=True):
                visits = next(iter(shared.value.search(asked.value[1][q : q + 1], probes)))
                turn = np.empty(probes, np.int64)
                turn[visits] = np.arange(1, probes + 1)
                yield pa.RecordBatch.from_arrays([pa.array(turn[np.array(lists)].min(axis=1))], names=["needed"])

    return task


def fitted_probes(members: DataFrame, queries: DataFrame, shared, width: int, k: int, least: int) -> int:
    """The leaves to visit so that ``RECALL`` of the neighbours of ``FITTED`` of the queries are found; ``least`` at least.

    ``members`` are ``(ids, v)`` and ``queries`` are ``(query_id, v)``, both as ``nearest`` makes them.
    """
    leaves = shared.value.leaves
    if leaves <= least:
        return least
    some = queries.orderBy(F.xxhash64("query_id", "v")).limit(FITTED).toArrow()
    if not len(some):
        return least
    spark = members.sparkSession
    asked = spark.sparkContext.broadcast((some.column("query_id").to_numpy(), _matrix(some.column("v").combine_chunks(), width)))
    found = members.mapInArrow(_exact_task(shared, asked, width, k), "q long, vec_id long, score double, leaves array<long>")
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    # Searches of all leaves take long in a large forest, so they are dealt out one by one.
    lists = found.groupBy("q").agg(F.collect_list("leaves").alias("leaves")).repartition(16, "q")
    needed = lists.mapInArrow(_needed_task(shared, asked, leaves), "needed long").toArrow().column("needed").to_numpy()
    if not len(needed):
        return least
    return max(least, int(np.sort(needed)[int(np.ceil(RECALL * len(needed))) - 1]))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, *, trees: int = TREES, leaf_rows: int = LEAF_ROWS, probes: int = PROBES, sample: int = SAMPLE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query the ``k`` vectors of largest inner product found.

    ``vectors`` and ``queries`` are ``(id long, v array)``. Rows without id, and vectors that are null, empty,
    zero or hold a null or non-finite component, take no part; nor do vectors of another length than the most. A row whose
    id is the query's is no candidate. Ties go to smaller ids, scores are inner products of the
    given components in double precision. If nothing is usable there are no rows. Further columns are ignored.
    At least ``probes`` leaves are visited, and as many more as the table needs.
    """
    spark = vectors.sparkSession

    def prepared(rows: DataFrame) -> DataFrame:
        return rows.select("id", usable(F.col("v")).alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())

    rows = prepared(vectors)
    size = rows.groupBy(F.size("v").alias("width")).count().orderBy(F.col("count").desc(), "width").first()
    width = size.width if size else 1
    rows = rows.where(F.size("v") == width).distinct()
    # Equal vectors become one; only the smallest ids can be results, and only so many are gathered.
    copies = Window.partitionBy("v").orderBy("id")
    rows = rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1)
    merged = settled(rows.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "vectors")
    n, longest = merged.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()

    drawn = merged.orderBy(F.xxhash64("v")).limit(sample).select("v").toArrow().column("v").combine_chunks()
    points = _matrix(drawn, width)
    # The sample's leaves stand for more vectors than they hold of it.
    leaf = max(8, round(leaf_rows * len(points) / max(n, 1)))
    forest = spark.sparkContext.broadcast(Forest(points, float(np.sqrt(longest or 1.0)) or 1.0, trees, leaf))

    members = merged.mapInArrow(_route_task(forest, width), "leaf long, ids array<long>, v array<double>")
    asked = prepared(queries).where(F.size("v") == width).select(F.col("id").alias("query_id"), "v").distinct()
    probes = fitted_probes(merged, asked, forest, width, k, probes)
    asked = asked.mapInArrow(_search_task(forest, width, probes), "leaf long, query_id long, v array<double>")
    if n > PART_ROWS:
        # Leaves are few (they come from the sample), so their parts are known to all tasks.
        parts = members.groupBy("leaf").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("parts"))
        members = members.join(F.broadcast(parts), "leaf").withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int")).drop("parts")
        asked = asked.join(F.broadcast(parts), "leaf").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    else:
        members, asked = members.withColumn("part", F.lit(0)), asked.withColumn("part", F.lit(0))
    best = asked.groupBy("leaf", "part").cogroup(members.groupBy("leaf", "part")).applyInArrow(_rank_task(width, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    best = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
