"""Near-duplicates by SetSketch registers: banded, judged by joint likelihood, confirmed on whole sets.

A text's set holds the 64-bit hashes of its distinct word n-grams. Register i of a set is

    min(Q + 1, max(0, floor(1 - log_B(min over elements of x_i)))),  x_i exponentially distributed with rate A:

truncated minima, exponentially spaced. Registers of a union are the larger ones of its parts, so sketches merge; and
those of two sets agree the likelier, the more alike the sets are. Sets that agree in all ``ROWS`` registers of
one of ``BANDS`` bands are candidates: at similarity 0.8 all but one pair in 10,000.

* Texts with equal sets are one class, formed by an aggregation with map-side combine.
* Large bands are taken apart by ``pivots``, which links or separates their members exactly.
* Of other candidates the similarity is estimated from all registers and both set sizes together, by maximum likelihood. A pair goes
  only if the threshold is less likely than the estimate by a factor of e^``DOUBT``, one similar pair in a million.
* What is left is compared on whole sets: first each set's likeliest partner, then what that has not connected yet.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm import pivots, sieve, textbytes
from tidemart.llm.jaccard import shingle_sets
from tidemart.llm.tables import settled

# The sketch: base, rate and largest register of 16 bits; exact to sets of 10^18 elements.
B, A, Q = 1.001, 20.0, 2**16 - 2
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
DOUBT = 12.0
# Similarities tried for an estimate.
STEPS = 128
# Elements that are hashed at once, to stay in the processor's cache.
AT_ONCE = 1 << 16

_SEEDS = textbytes.mixed(np.arange(1, REGISTERS + 1, dtype=np.uint64) * textbytes.BASE)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """The registers (set, register) of some sets, none of them empty."""
    out = np.empty((len(sets), REGISTERS), np.uint16)
    row = 0
    while row < len(sets):
        stop, total = row, 0
        while stop < len(sets) and (stop == row or total + len(sets[stop]) <= AT_ONCE):
            total += len(sets[stop])
            stop += 1
        least = np.full((stop - row, REGISTERS), 2**64 - 1, np.uint64)
        tokens = np.concatenate(sets[row:stop])
        starts = np.cumsum([0, *map(len, sets[row : stop - 1])])
        if stop - row > 1:
            _minima(tokens, starts, least)
        else:  # one set, which may be long
            for a in range(0, len(tokens), AT_ONCE):
                part = np.empty_like(least)
                _minima(tokens[a : a + AT_ONCE], starts, part)
                np.minimum(least, part, out=least)
        u = (least.astype(float) + 0.5) / 2.0**64
        level = np.floor(1.0 - np.log(-np.log1p(-np.minimum(u, 1 - 2.0**-53)) / A) / math.log(B))
        out[row:stop] = np.clip(level, 0, Q + 1)
        row = stop
    return out


def _minima(tokens: np.ndarray, starts: np.ndarray, out: np.ndarray) -> None:
    """For each register, the least hash of each run of tokens."""
    h, shifted = np.empty_like(tokens), np.empty_like(tokens)
    for k in range(REGISTERS):
        np.bitwise_xor(tokens, _SEEDS[k], out=h)
        np.multiply(h, np.uint64(0xBF58476D1CE4E5B9), out=h)
        np.right_shift(h, np.uint64(32), out=shifted)
        np.bitwise_xor(h, shifted, out=h)
        np.multiply(h, np.uint64(0x94D049BB133111EB), out=h)
        out[:, k] = np.minimum.reduceat(h, starts)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of a union."""
    return np.maximum(a, b)


def bands(found: np.ndarray) -> np.ndarray:
    """A hash (set, band) of each band's registers."""
    parts = found.reshape(len(found), BANDS, ROWS).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(ROWS):
        out = textbytes.mixed((out << np.uint64(16)) * textbytes.BASE + parts[:, :, k])
    return out


def likelihood(more: np.ndarray, less: np.ndarray, share: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Log-likelihood of similarity ``j``, where so many of the one set's registers are larger, and so many smaller, than the other's.

    ``share`` is the first set's part of the sum of both sizes. One register is larger with probability
    -log_B(1 - (share - (1 - share) * j) * (B - 1) / B).
    """
    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.maximum(x, 0.0) * (B - 1) / B) / math.log(B)

    up, down = p(share - (1 - share) * j), p((1 - share) - share * j)
    terms = ((more, up), (less, down), (REGISTERS - more - less, 1 - up - down))
    with np.errstate(divide="ignore", invalid="ignore"):
        return sum(np.where(n > 0, n * np.log(np.maximum(x, 1e-300)), 0.0) for n, x in terms)


def estimate(a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The likeliest similarity of each pair of registers, and whether one of ``least`` or more is to be reckoned with."""
    more, less = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    share = (a_size / (a_size + b_size))[:, None]
    most = np.minimum(share / (1 - share), (1 - share) / share)
    tried = most * np.linspace(0.0, 1.0, STEPS)[None, :]
    known = likelihood(more, less, share, tried)
    at = known.argmax(axis=1)[:, None]
    best, value = np.take_along_axis(tried, at, 1), np.take_along_axis(known, at, 1)
    limit = np.minimum(least, most)
    near = (best >= least) | (value - likelihood(more, less, share, limit) <= DOUBT)
    return best[:, 0], (near & (most >= least - 1e-9))[:, 0]


def _digest(tokens: np.ndarray) -> bytes:
    """Names a set: 128 bits, equal for equal sets."""
    return blake2b(tokens.tobytes(), digest_size=16).digest()


def _mark(digests: list[bytes], ids: list) -> np.ndarray:
    """64 bits for a set and one of its ids."""
    sets = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)[:, 0]
    return textbytes.mixed(sets + textbytes.mixed(np.array([0 if i is None else i for i in ids], np.int64).view(np.uint64)))


def _sketch_task(n: int):
    """Each row's set, by name and size; with its registers where the task meets it first."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in batches:
            for row, data, offsets in textbytes.blocks(batch.column("text")):
                sets = shingle_sets(data, offsets, n)
                names = [_digest(s) for s in sets]
                fresh = []
                for k, (name, s) in enumerate(zip(names, sets, strict=True)):
                    if len(s) and name not in met:
                        met.add(name)
                        fresh.append(k)
                sketches: list[bytes | None] = [None] * len(sets)
                for k, found in zip(fresh, registers([sets[k] for k in fresh]) if fresh else [], strict=True):
                    sketches[k] = found.tobytes()
                ids = batch.column("id").slice(row, len(sets))
                marks = _mark(names, ids.to_pylist()).view(np.int64)
                columns = [ids, pa.array(names, pa.binary()), pa.array([len(s) for s in sets], pa.int64()), pa.array(sketches, pa.binary()), pa.array(marks)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "name", "n", "registers", "mark"])

    return task


def _band_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, len(batch), 4096):
            part = batch.slice(a, 4096)
            found = np.stack([np.frombuffer(x, np.uint16) for x in part.column("registers").to_pylist()])
            keys = bands(found).view(np.int64).reshape(-1)
            columns = [keys, *(np.repeat(part.column(c).to_numpy(), BANDS) for c in ("node", "n"))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "node", "n"])


def _set_task(n: int, wanted):
    """The sets asked for, each from the rows that carry its first id."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in batches:
            for row, data, offsets in textbytes.blocks(batch.column("text")):
                sets = shingle_sets(data, offsets, n)
                names = [_digest(s) for s in sets]
                passing = sieve.passes(wanted.value, _mark(names, batch.column("id").slice(row, len(sets)).to_pylist()))
                own = []
                for k in np.flatnonzero(passing):
                    if len(sets[k]) and names[k] not in met:
                        met.add(names[k])
                        own.append(k)
                lengths = np.cumsum([0, *(len(sets[k]) for k in own)])
                flat = np.concatenate([np.zeros(0, np.uint64), *(sets[k] for k in own)]).view(np.int64)
                tokens = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([pa.array([names[k] for k in own], pa.binary()), tokens], names=["name", "tokens"])

    return task


def _estimate_task(least: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 2048):
                part = batch.slice(k, 2048)
                a, b = (np.stack([np.frombuffer(x, np.uint16) for x in part.column(c).to_pylist()]) for c in ("ra", "rb"))
                best, near = estimate(a, b, *(part.column(c).to_numpy().astype(float) for c in ("na", "nb")), least)
                keep = pa.array(near)
                columns = [part.column("a").filter(keep), part.column("b").filter(keep), pa.array(best[near])]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "likely"])

    return task


def near_duplicates(documents: DataFrame, *, words: int = 4, num: int = 80, den: int = 100) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` for every row of ``documents (id long, text string)``.

    Rows link when ``den * |intersection| >= num * |union|`` of their sets; a component is named by the smallest id it
    holds, and its rows of that id are kept. Null and empty texts, and those of white space only, have an empty set
    and link with nothing: each such row is its own component. Fewer words than a shingle has: all of them are one. Rows
    with equal texts, or equal ids, keep a row each. A null id never names a component that also holds other ids.
    Further columns are ignored; without rows there is no result.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    schema = "id long, name binary, n long, registers binary, mark long"
    found = settled(rows.mapInArrow(_sketch_task(words), schema), "sketches")
    some = found.where("n > 0").groupBy("name").agg(
        F.min("id").alias("least"), F.max("n").alias("n"), F.max("registers").alias("registers"), F.min(F.struct("id", "mark"))["mark"].alias("mark")
    )
    # As a table, so that the numbers stay.
    classes = settled(some.withColumn("node", F.monotonically_increasing_id()), "classes")

    def sets_of(nodes: DataFrame) -> DataFrame:
        asked = settled(classes.select("name", "node", "mark").join(nodes, "node"), "asked")  # read three times
        wanted = spark.sparkContext.broadcast(sieve.bitmap(asked.select("mark")))
        made = rows.mapInArrow(_set_task(words, wanted), "name binary, tokens array<long>")
        return made.join(asked.select("name", "node"), "name").groupBy("node").agg(F.first("tokens").alias("tokens"))

    banded = classes.select("registers", "node", "n").mapInArrow(_band_task, "bucket long, node long, n long")
    held = banded.select("bucket", "node", "n", F.col("n").alias("d"), F.lit(0).cast("long").alias("pos"), F.col("node").alias("side"))
    sure, pairs = pivots.met(held, sets_of, num, den)

    near = pairs
    for side in "ab":
        near = near.join(classes.select(F.col("node").alias(side), F.col("n").alias(f"n{side}"), F.col("registers").alias(f"r{side}")), side)
    near = settled(near.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_estimate_task(num / den), "a long, b long, likely double"), "near")
    whole = pivots.linked_groups(near, sure, sets_of, num, den)

    member = classes.select("name", "least", "node").join(whole.withColumnRenamed("component", "group"), "node", "left")
    member = member.select("name", "least", F.coalesce("group", "node").alias("group"))
    named = member.join(member.groupBy("group").agg(F.min("least").alias("component_id")), "group").select("name", "component_id")
    empty = F.col("n") == 0
    out = found.select("id", "n", F.when(~empty, F.col("name")).alias("name")).join(named, "name", "left")
    out = out.select("id", F.col("n").alias("n_shingles"), F.when(empty, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
