"""Exact top-k by integer inner product over a bit-sliced index.

The rows are dealt into blocks. In a block every component is shifted to be non-negative and stored as bit
slices: one bitmap over the block's rows for each binary digit. For a query the slices are added up with
bitmap arithmetic: a weight's binary digits choose which slices of a component enter, and at which digit of
the sum; a negative weight takes the complements. Carry-save adders fold three bitmaps of a digit
into one and a carry, for a batch of queries at once, until every digit of the sum has one bitmap. The top rows are
then selected from the most significant digit downward; rows that tie at the boundary are settled by id.

Every query meets every block, as the task is exact. Blocks and queries are dealt on a grid: a cell holds a bounded group of
blocks, sliced once, and its share of the queries comes by in batches. What is shuffled is the index once a column of the grid and the queries
once a row of it. A block hands on only its ``k`` best rows a query, with scores recomputed from the stored integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK_ROWS = 8192
QUERY_ROWS = 256
# So many queries are added up together; bounds the bitmaps held at once.
TOGETHER = 16
# So many blocks, sliced, are held by a task.
BLOCKS_HELD = 8
_FOUND = "query_id long, vec_id long, score long"
_CELL = ["group", "share", "width"]


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component as bigint; null where the vector or a component is null or not finite."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    odd = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(doubles, lambda x: F.floor(x * scale).cast("long"))
    return F.when(vector.isNotNull() & ~odd, whole)


def slices(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps (component, digit, byte of rows) of the shifted components, and the shifts."""
    low = values.min(axis=0)
    shifted = (values - low).astype(np.uint64)
    digits = max(1, int(shifted.max()).bit_length())
    bits = (shifted.T[:, None, :] >> np.arange(digits, dtype=np.uint64)[None, :, None]) & np.uint64(1)
    packed = np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")
    pad = -packed.shape[2] % 8
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, 0), (0, pad)))).view(np.uint64), low


def add_up(index: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """The digits of sum(|w| * x or its complement) for each query: bitmaps (query, word), lowest digit first."""
    queries, width = len(weights), index.shape[2]
    digits = index.shape[1]
    waiting: dict[int, list[np.ndarray]] = {}

    def put(digit: int, bitmap: np.ndarray) -> None:
        """Add a bitmap to a digit; two that wait there and this one become a sum bit and a carry."""
        while True:
            stack = waiting.setdefault(digit, [])
            if len(stack) < 2:
                stack.append(bitmap)
                return
            a, b = stack.pop(), stack.pop()
            odd = a ^ b
            carry = (a & b) | (odd & bitmap)
            stack.append(odd ^ bitmap)
            digit, bitmap = digit + 1, carry

    size = np.abs(weights)
    flip = np.where(weights < 0, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
    for d in range(weights.shape[1]):
        rows = [index[d, b][None, :] ^ flip[:, d, None] for b in range(digits)]
        for j in range(int(size[:, d].max()).bit_length()):
            takes = ((size[:, d] >> j) & 1).astype(bool)
            if takes.any():
                mask = np.where(takes, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))[:, None]
                for b in range(digits):
                    put(b + j, rows[b] & mask)
    out, digit = [], 0
    while any(waiting.get(k) for k in waiting if k >= digit):
        stack = waiting.setdefault(digit, [])
        if len(stack) == 2:
            a, b = stack
            waiting[digit] = [a ^ b]
            put(digit + 1, a & b)
        out.append(waiting[digit][0] if waiting[digit] else np.zeros((queries, width), np.uint64))
        waiting[digit] = []
        digit += 1
    return out


def select_top(digits: list[np.ndarray], k: int, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From the highest digit down: the rows surely among the ``k`` largest, and those that tie for the rest."""
    sure, tied = np.zeros_like(allowed), allowed.copy()
    count = lambda x: np.bitwise_count(x).sum(axis=1, dtype=np.int64)[:, None]
    for bitmap in reversed(digits):
        ones = tied & bitmap
        many = count(sure | ones) > k
        sure, tied = np.where(many, sure, sure | ones), np.where(many, ones, tied & ~bitmap)
    return sure, tied


def _rows_of(bitmap: np.ndarray, rows: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), count=rows, bitorder="little"))


def grid(blocks: int, batches: int, ratio: float, tasks: int) -> tuple[int, int]:
    """How many groups of blocks and how many shares of the queries there are: about as many cells as ``tasks``.

    With ``ratio`` rows a query, copies of both take the least together if there are so many groups to a share.
    """
    groups = min(blocks, max(1, round(math.sqrt(tasks * ratio)), -(-blocks // BLOCKS_HELD)))
    return groups, min(batches, max(1, -(-tasks // groups)))


def _best(block: tuple, asked: np.ndarray, weights: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For each query its best rows of the block: the query's id, theirs, and their scores."""
    ids, values, index = block
    everyone = np.packbits(np.ones(len(ids), np.uint8), bitorder="little")
    everyone = np.pad(everyone, (0, index.shape[2] * 8 - len(everyone))).view(np.uint64)
    for a in range(0, len(asked), TOGETHER):
        own, part = asked[a : a + TOGETHER], weights[a : a + TOGETHER]
        allowed = np.repeat(everyone[None, :], len(own), axis=0)
        first, last = np.searchsorted(ids, own), np.searchsorted(ids, own, "right")
        for q in range(len(own)):
            for r in range(first[q], last[q]):
                allowed[q, r >> 6] &= ~(np.uint64(1) << np.uint64(r & 63))
        sure, tied = select_top(add_up(index, part), k, allowed)
        for q in range(len(own)):
            rows = _rows_of(sure[q], len(ids))
            rows = np.concatenate([rows, _rows_of(tied[q], len(ids))[: k - len(rows)]])
            yield np.full(len(rows), own[q]), ids[rows], values[rows] @ part[q]


def _top_task(k: int):
    """Cells, blocks before batches of queries, become each query's best rows of each block."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []
        for batch in batches:
            for i in range(len(batch)):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                own = tuple(row[c].as_py() for c in _CELL)
                if own != cell:
                    cell, held = own, []
                ids = row["ids"].values.to_numpy()
                values = row["flat"].values.to_numpy().reshape(len(ids), row["width"].as_py())
                if row["batch"].as_py() < 0:
                    by = np.argsort(ids, kind="stable")  # within a block, the lower row has the smaller id
                    held.append((ids[by], values[by], slices(values[by])[0]))
                    continue
                for block in held:
                    columns = [np.concatenate(x) for x in zip(*_best(block, ids, values, k), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    return task


def _packed(rows: DataFrame, group: str) -> DataFrame:
    """One row for each group: its ids, and its vectors end to end."""
    pairs = F.collect_list(F.struct("id", "v"))
    out = rows.groupBy(group, "width").agg(pairs.alias("pairs"))
    return out.select(group, "width", F.col("pairs.id").alias("ids"), F.flatten(F.col("pairs.v")).alias("flat"))


def top(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` rows of largest inner product, ties to smaller ids.

    ``vectors`` and ``queries`` are ``(id long, v array<long>)``; a row whose id is the query's is no candidate.
    Rows without id or vector, and queries of another length than a row, don't meet; empty vectors take no part. Rows equal
    in id and vector are one row. Scores, and sums on the way, must fit in 63 bits. Further columns are ignored.
    """
    def usable(rows: DataFrame) -> DataFrame:
        rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
        return rows.select("id", "v", F.size("v").alias("width")).distinct()

    spark = vectors.sparkSession
    rows, asked = usable(vectors), usable(queries)
    n_rows, n_asked = rows.count(), asked.count()
    blocks, batches = max(1, -(-n_rows // BLOCK_ROWS)), max(1, -(-n_asked // QUERY_ROWS))
    groups, shares = grid(blocks, batches, n_rows / max(1, n_asked), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))

    def dealt(rows: DataFrame, name: str, parts: int) -> DataFrame:
        return _packed(rows.withColumn(name, F.pmod(F.xxhash64("id", "v"), F.lit(parts)).cast("int")), name)

    def copied(name: str, parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias(name)

    index = dealt(rows, "block", blocks).select((F.col("block") % groups).alias("group"), copied("share", shares), "width", F.lit(-1).alias("batch"), "ids", "flat")
    # The stated queries against all rows, in blocks: a batch of queries visits every group of blocks.
    asked = dealt(asked, "batch", batches).select(copied("group", groups), (F.col("batch") % shares).alias("share"), "width", "batch", "ids", "flat")
    cells = index.unionByName(asked).repartition(groups * shares, *_CELL).sortWithinPartitions(*_CELL, "batch")
    best = cells.mapInArrow(_top_task(k), _FOUND)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = best.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


TOP_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE) for x in embedding] AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.vec_id % 20 = 0 AND len(a.q) = len(b.q))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 20"""
