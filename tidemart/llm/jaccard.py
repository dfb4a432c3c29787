"""Similarity join on word shingles: prefix filters under several global token orders.

A text's set holds the 64-bit hashes of its distinct word n-grams. Two sets with Jaccard similarity of
``least`` or more must share a token within their first ``size - ceil(least * size) + 1`` tokens, under
*any* order of all tokens. Three orders are used; a pair is verified only if it passes all of them.

How hot tokens and groups of copies are kept apart:

* texts with equal sets are one class, formed by an aggregation with map-side combine;
* all orders put shingles of common words late: words are counted over the whole input in a sketch of
  fixed size, and what a shingle's words give is the class of its expected frequency. Shingles found to be
  in more than ``FREQUENT`` prefixes, such as a passage that many texts share, come last;
* many holders of one token are not compared with each other: ``pivots`` links or separates them by their differences to
  one of them, exactly, and leaves pairs of small groups. These have to pass the other orders and are then compared on whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm import pivots, sieve, textbytes
from tidemart.llm.tables import dropped, settled

# Slots of the frequency sketch: a fixed size, so it may be sent to every task.
SLOTS = 1 << 16
# Levels of words are whole parts of a power of two, so that sums do not depend on what stands before them.
LEVEL_PARTS = 100
# Shingles are of one frequency class within so many powers of two.
CLASS_BITS = 3
# Tokens that more classes hold are frequent; they are remembered by so many bits of theirs.
FREQUENT, FREQUENT_BITS = 24, 22
# Bits by which the tokens are told apart of which more than one class has; a clash only costs a shuffled row.
SHARED_BITS = 25
ORDERS = 3
# Up to so many holders of a token are compared pair by pair, where sizes and places leave room; beyond that they are mostly copies.
FEW_HOLDERS = 256


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word's hash, A-Z lower-cased, and how many words stand before each text."""
    starts, ends, at = textbytes.words(data, offsets)
    return textbytes.span_hashes(textbytes.LOWER[data], starts, ends), at


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(SLOTS - 1)).astype(np.int64)


def word_levels(slots: np.ndarray) -> np.ndarray:
    """How common each slot's words are, in parts of a power of two; 0 up to the median slot."""
    return np.rint(LEVEL_PARTS * np.log2(np.maximum(slots / max(1.0, float(np.median(slots))), 1.0))).astype(np.int64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int, common: tuple[np.ndarray, np.ndarray] | None = None) -> list:
    """The sorted distinct shingle hashes of each text. Fewer words than ``n``: all of them are one shingle.

    With ``common``, how common each slot's words are and which slots' shingles are frequent, each set comes with
    its frequency classes.
    """
    hashes, at = word_hashes(data, offsets)
    out = []
    rolled = hashes.copy()
    for k in range(1, n):
        rolled[: len(hashes) - k] = textbytes.mixed(rolled[: len(hashes) - k] * textbytes.BASE + hashes[k:])
    if common is not None:
        # A shingle of common words is expected to be common: the logs add up.
        logs = np.concatenate([[0], np.cumsum(common[0][_slot(hashes)], dtype=np.int64)])
        expected = np.zeros(len(hashes), np.int64)
        expected[: max(len(hashes) - n + 1, 0)] = logs[n:] - logs[: len(logs) - n] if len(hashes) >= n else 0
        classes = np.minimum(expected // (CLASS_BITS * LEVEL_PARTS), 31).astype(np.uint64)
        classes[_set_in(common[1], FREQUENT_BITS, rolled)] += np.uint64(32)
        for a, b in zip(at[:-1], at[1:], strict=True):
            if b - a >= n:
                tokens, first = np.unique(rolled[a : b - n + 1], return_index=True)
                out.append((tokens, classes[a + first]))
            else:
                out.append((_short(hashes[a:b]), np.zeros(int(b > a), np.uint64)))
        return out
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= n:
            out.append(np.unique(rolled[a : b - n + 1]))
        else:
            out.append(_short(hashes[a:b]))
    return out


def _short(hashes: np.ndarray) -> np.ndarray:
    """The set of a text of fewer words than a shingle has."""
    whole = hashes[:1].copy()
    for h in hashes[1:]:
        whole = textbytes.mixed(whole * textbytes.BASE + h)
    return textbytes.mixed(whole ^ np.uint64(len(hashes)))


def _lists(values: list[np.ndarray]) -> pa.Array:
    lengths = np.cumsum([0, *map(len, values)])
    flat = np.concatenate([np.zeros(0, np.uint64), *values]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat, pa.int64()))


def _key(tokens: np.ndarray) -> int:
    """The class of a set: a 64-bit digest, equal for equal sets."""
    return int.from_bytes(blake2b(tokens.tobytes(), digest_size=8).digest(), "big", signed=True)


def _mark(keys: list[int], ids: list) -> np.ndarray:
    """64 bits for a class and one of its ids."""
    own = textbytes.mixed(np.array([0 if i is None else i for i in ids], np.int64).view(np.uint64))
    return textbytes.mixed(np.array(keys, np.int64).view(np.uint64) + own)


def _lengths(sets: list[np.ndarray]) -> pa.Array:
    return pa.array([len(s) for s in sets], pa.int64())


def _class_task(n: int):
    """Each row's class, and after them how often each slot's words occur in the task's rows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for row, data, offsets in textbytes.blocks(batch.column("text"), textbytes.SMALL_BLOCK_BYTES):
                sets = shingle_sets(data, offsets, n)
                total += np.bincount(_slot(word_hashes(data, offsets)[0]), minlength=SLOTS)
                nothing, keys, ids = pa.nulls(len(sets), pa.int64()), [_key(x) for x in sets], batch.column("id").slice(row, len(sets))
                marks = pa.array(_mark(keys, ids.to_pylist()).view(np.int64))
                columns = [ids, pa.array(keys, pa.int64()), _lengths(sets), marks, nothing, nothing]
                yield pa.RecordBatch.from_arrays(columns, names=_CLASSES)
        used = np.flatnonzero(total)
        nothing = pa.nulls(len(used), pa.int64())
        columns = [nothing, nothing, nothing, nothing, pa.array(used), pa.array(total[used])]
        yield pa.RecordBatch.from_arrays(columns, names=_CLASSES)

    return task


_CLASSES = ["id", "key", "n_shingles", "mark", "slot", "n"]


def prefix(tokens: np.ndarray, classes: np.ndarray, order: int, num: int, den: int) -> np.ndarray:
    """The first tokens of a set, in the order: by frequency class, then by a hash of the order's own."""
    size = len(tokens)
    keep = size - (num * size + den - 1) // den + 1
    place = (classes << np.uint64(58)) | (textbytes.mixed(tokens + np.uint64(order + 1)) >> np.uint64(6))
    first = np.argpartition(place, keep - 1)[:keep] if 0 < keep < size else np.arange(size)
    return tokens[first[np.argsort(place[first], kind="stable")]]


def _posting_task(n: int, common, num: int, den: int, *, narrow: bool = False, shared=None):
    """The prefixes under the first order; a class that the task has met already is not repeated.

    Without ``shared`` their tokens alone, and if ``narrow`` only as many as two sets of equal size need; with it, the
    tokens whose bits are set there, each with its class, the set's size and its place in the order.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for _, data, offsets in textbytes.blocks(batch.column("text"), textbytes.SMALL_BLOCK_BYTES):
                tokens, keys, sizes = [np.zeros(0, np.uint64)], [], []
                for s, classes in shingle_sets(data, offsets, n, common.value):
                    key = _key(s)
                    if len(s) and key not in met:
                        met.add(key)
                        reach = len(s) - -(-2 * len(s) * num // (num + den)) + 1 if narrow else None
                        tokens.append(prefix(s, classes, 0, num, den)[:reach])
                        keys.append(key)
                        sizes.append(len(s))
                times = [len(t) for t in tokens[1:]]
                token = np.concatenate(tokens)
                if shared is None:
                    yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64))], names=["token"])
                    continue
                columns = [np.repeat(np.array(c, np.int64), times) for c in (keys, sizes)]
                columns.append(np.concatenate([np.zeros(0, np.int64), *map(np.arange, times)]))
                keep = _set_in(shared.value, SHARED_BITS, token)
                yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (token.view(np.int64), *columns)], names=["token", "key", "n", "pos"])

    return task


def _bitmap(tokens: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of the tokens' leading bits, put together where the tokens are: 2^(bits - 6) words at most."""
    slot = F.shiftrightunsigned("token", 64 - bits)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(token, {64 - bits}) & 63 as int))")
    found = tokens.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint64)


def _set_in(bitmap: np.ndarray, bits: int, tokens: np.ndarray) -> np.ndarray:
    slot = tokens >> np.uint64(64 - bits)
    return (bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) > 0


def _set_task(n: int, common, wanted, num: int, den: int, *, whole: bool):
    """The whole sets of the classes asked for, or their prefixes under the further orders, from the rows that carry their first id."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for row, data, offsets in textbytes.blocks(batch.column("text"), textbytes.SMALL_BLOCK_BYTES):
                sets = shingle_sets(data, offsets, n, common.value)
                keys = [_key(t) for t, _ in sets]
                passing = sieve.passes(wanted.value, _mark(keys, batch.column("id").slice(row, len(sets)).to_pylist()))
                own = []
                for k in np.flatnonzero(passing):
                    if len(sets[k][0]) and keys[k] not in met:
                        met.add(keys[k])
                        own.append((keys[k], sets[k]))
                node, size = pa.array([k for k, _ in own], pa.int64()), _lengths([t for _, (t, _) in own])
                if whole:
                    yield pa.RecordBatch.from_arrays([node, _lists([t for _, (t, _) in own])], names=["node", "tokens"])
                else:
                    orders = [[prefix(*s, k, num, den) for _, s in own] for k in range(1, ORDERS)]
                    yield pa.RecordBatch.from_arrays([node, size, *map(_lists, orders)], names=["node", "n", *_OTHERS])

    return task


_OTHERS = [f"p{k}" for k in range(1, ORDERS)]


def _reach(x: Column, y: Column, num: int, den: int) -> Column:
    """How many of ``x``'s first tokens can hold the first one shared, if the sets are similar: 0 or less for none."""
    least = F.ceil((x + y) * num / F.lit(float(num + den)) - 1e-9)  # tokens that similar sets share
    return F.when(F.least(x, y) * den >= F.greatest(x, y) * num, x - least + 1).otherwise(0)


def linked(documents: DataFrame, *, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``(id, n_shingles, component_id)`` for every row of ``documents (id long, text string)``.

    Two rows link when ``den * |intersection| >= num * |union|`` of their sets; a component is named by the
    smallest id it holds. Null and empty texts, and those of white space only, have an empty set and link
    with nothing: each such row is its own component. Rows with equal texts, or equal ids, keep a row each. A
    null id never names a component that also holds other ids. Further columns are ignored.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    found = settled(
        rows.mapInArrow(_class_task(words), "id long, key long, n_shingles long, mark long, slot long, n long"), "classes"
    )
    classed = found.where("slot is null").select("id", "key", "n_shingles", "mark")
    slots = np.zeros(SLOTS)
    for slot, n in found.where("slot is not null").groupBy("slot").agg(F.sum("n")).collect():  # at most SLOTS rows
        slots[slot] = n
    words_level = word_levels(slots)
    # A first round of prefixes shows which of their tokens many classes hold; those go behind all others.
    send = spark.sparkContext.broadcast

    def tokens(levels, **options) -> DataFrame:
        task = _posting_task(words, levels, num, den, **options)
        return rows.mapInArrow(task, "token long").groupBy("token").count()

    nothing = np.zeros(1 << (FREQUENT_BITS - 6), np.uint64)
    frequent = _bitmap(tokens(send((words_level, nothing)), narrow=True).where(F.col("count") > FREQUENT), FREQUENT_BITS)
    levels = send((words_level, frequent))
    # A second one shows which tokens lead anywhere: more than one task or class has them.
    shared = send(_bitmap(tokens(levels).where("count > 1"), SHARED_BITS))
    held = rows.mapInArrow(_posting_task(words, levels, num, den, shared=shared), "token long, key long, n long, pos long")
    held = settled(held, "held")
    several = held.groupBy("token").agg((F.min("key") < F.max("key")).alias("several")).where("several").select("token")
    postings = settled(held.join(several, "token").distinct(), "postings")
    dropped(held)

    names = classed.where("n_shingles > 0").groupBy("key").agg(F.min("id").alias("least"), F.min(F.struct("id", "mark"))["mark"].alias("mark"))
    names = settled(names, "names")

    def made(nodes: DataFrame, schema: str, *, whole: bool) -> DataFrame:
        """What the task makes of the classes, from the text of one row each; each once."""
        asked = settled(names.select(F.col("key").alias("node"), "mark").join(nodes, "node"), "asked")  # read three times
        wanted = send(sieve.bitmap(asked.select("mark")))
        out = rows.mapInArrow(_set_task(words, levels, wanted, num, den, whole=whole), schema).join(asked.select("node"), "node")
        return out.groupBy("node").agg(*[F.first(c).alias(c) for c in out.columns if c != "node"])

    def sets_of(nodes: DataFrame) -> DataFrame:
        return made(nodes, "node long, tokens array<long>", whole=True)

    met = postings.select(F.col("token").alias("bucket"), F.col("key").alias("node"), "n", F.col("n").alias("d"), "pos", F.col("key").alias("side"))
    sure, near = pivots.met(met, sets_of, num, den, few=FEW_HOLDERS, by_size=True)
    dropped(postings)
    ends = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    few = settled(made(ends, "node long, n long, " + ", ".join(f"{p} array<long>" for p in _OTHERS), whole=False), "prefixes")
    for side in "ab":
        near = near.join(few.select(F.col("node").alias(side), *[F.col(p).alias(f"{p}{side}") for p in ("n", *_OTHERS)]), side)
    for p in _OTHERS:
        first = [F.slice(f"{p}{x}", 1, F.greatest(_reach(F.col(f"n{x}"), F.col(f"n{y}"), num, den), F.lit(0)).cast("int")) for x, y in ("ab", "ba")]
        near = near.where(F.arrays_overlap(*first))
    # Of sets of like size the likelier ones are compared first.
    near = settled(near.select("a", "b", (-F.abs(F.col("na") - F.col("nb"))).cast("double").alias("likely")), "near")
    dropped(few)
    whole = pivots.linked_groups(near, sure, sets_of, num, den).withColumnRenamed("component", "group")

    member = names.select("key", "least").join(whole.withColumnRenamed("node", "key"), "key", "left")
    member = member.select("key", "least", F.coalesce("group", "key").alias("group"))
    named = member.join(member.groupBy("group").agg(F.min("least").alias("component_id")), "group").select("key", "component_id")
    empty = F.col("n_shingles") == 0
    out = classed.select("id", "n_shingles", F.when(~empty, F.col("key")).alias("key")).join(named, "key", "left")
    return out.select("id", "n_shingles", F.when(empty, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
