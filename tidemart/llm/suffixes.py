"""Removal of repeated byte strings, by sorting suffixes deep-shallow.

A byte goes when it lies in a string of ``SPAN`` bytes that also starts earlier: in a text with a smaller
id, or further left in the same text.

Sorting every suffix of a corpus would shuffle it a hundredfold. Instead:

1. Of texts that are equal byte for byte, the first alone goes on; the others are wholly repeated.
2. Every window of ``SPAN`` bytes picks an *anchor*: the position in it whose ``GRAM`` bytes hash lowest.
   Equal windows pick equal grams, so a window can repeat only if its anchor's gram does. Grams that occur
   once are left behind after a shuffle of 24 bytes for about every 35 bytes of text.
3. Around each remaining anchor its context is cut out: all bytes of the windows that picked it. Equal
   contexts are merged in the batch of texts they are cut from, so a passage in very many texts reaches the
   next shuffle once per batch. A gram that may have more than ``CROWDED`` places, by a sketch of all grams,
   has its contexts cut up into windows: each is a context of one distance and meets only its equals, under
   a hash of its own. Surroundings that differ go to different tasks.
4. Contexts meet by gram. The suffixes to the right of the anchors and the reversed prefixes to their left
   are sorted: multikey quicksort on eight-byte characters down to ``SHALLOW`` bytes, then a blind trie for
   each group that is still equal there. Two windows at the same distance from their anchors are equal if
   the common prefixes on both sides are long enough; along the sorted orders these are runs, for all
   members at once, and no pairs are formed.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm import textbytes

SPAN = 100
GRAM = 32
REACH = SPAN - GRAM  # an anchor lies at most so far into its window
SHALLOW = 40
# Contexts are sorted together up to so many at a time; the contexts of one key are never parted.
TOGETHER = 100_000
# Grams of more places than this do not meet by gram, but window by window. Places are counted in slots, so
# some rarer grams may go the same way; this changes no result.
CROWDED = 100_000
SLOT_BITS = 18
_CONTEXT = "h long, id long, key long, at long, ctx binary"
_CONTEXT_NAMES = ["h", "id", "key", "at", "ctx"]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each position on, by doubling."""
    h = data.astype(np.uint64) + np.uint64(1)
    power, width = textbytes.BASE, 1
    while width < GRAM:
        h = h[: len(h) - width] * power + h[width:]
        power, width = power * power, width * 2
    return textbytes.mixed(h)


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each anchor's text, position in it, gram hash, and least and largest distance from its windows' starts."""
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    if len(data) < SPAN:
        return none
    with np.errstate(over="ignore"):
        hashes = gram_hashes(data)
    keys = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= REACH + 1:
        keys = np.minimum(keys[: len(keys) - width], keys[width:])
        width *= 2
    rest = REACH + 1 - width
    if rest:
        keys = np.minimum(keys[: len(keys) - rest], keys[rest:])
    picked = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
    lengths = np.maximum(np.diff(offsets) - SPAN + 1, 0)
    starts = np.repeat(offsets[:-1], lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    if not len(starts):
        return none
    at = picked[starts]
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    last = np.concatenate([new[1:], [len(at)]]) - 1
    where = at[new]
    text = np.searchsorted(offsets, where, "right") - 1
    return text, where - offsets[text], hashes[where].view(np.int64), where - starts[last], where - starts[new]


def _anchor_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.column("key").to_numpy()
        for row, data, offsets in textbytes.blocks(batch.column("text")):
            text, position, h, low, high = anchors(data, offsets)
            at = (position << 16) | (low << 8) | high
            key = keys[row + text]
            # Two of a gram's places show that it repeats; the block's further places need not meet them.
            by = np.argsort(h, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], h[by][1:] != h[by][:-1]])) if len(h) else by
            nth = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
            salt = np.zeros(len(h), np.int64)
            salt[by] = np.where(nth < 2, 0, 1 + (key[by] & 0xFFFF))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h, salt, key, at)], names=["h", "salt", "key", "at"])


def _often_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of places in order of their grams: those whose gram has another place, or is known to."""
    tail, given = None, True  # the batch before's last place, and whether it has been passed on
    for batch in batches:
        if not len(batch):
            continue
        h, salt = batch.column("h").to_numpy(), batch.column("salt").to_numpy()
        same = (h[1:] == h[:-1]) & (salt[1:] == salt[:-1])
        keep = salt != 0
        keep[1:] |= same
        keep[:-1] |= same
        if tail is not None and (tail.column("h")[0].as_py(), tail.column("salt")[0].as_py()) == (h[0], salt[0]):
            keep[0] = True
            if not given:
                yield tail.select(["h", "key", "at"])
        yield batch.filter(pa.array(keep)).select(["h", "key", "at"])
        tail, given = batch.slice(len(batch) - 1), bool(keep[-1])


def _slot(h: np.ndarray) -> np.ndarray:
    return (h.view(np.uint64) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many of the task's places have grams of each slot."""
    total = np.zeros(1 << SLOT_BITS, np.int64)
    for batch in batches:
        for _, data, offsets in textbytes.blocks(batch.column("text")):
            total += np.bincount(_slot(anchors(data, offsets)[2]), minlength=len(total))
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["slot", "n"])


def crowded_slots(rows: DataFrame) -> np.ndarray:
    """For each slot: may one of its grams have more than ``CROWDED`` places in the texts?"""
    counts = rows.select("text").mapInArrow(_count_task, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n") > CROWDED).toArrow()
    out = np.zeros(1 << SLOT_BITS, bool)
    out[found.column("slot").to_numpy()] = True
    # As in tables.settled: the counts' shuffle need not stay on disk.
    rows.sparkSession.sparkContext._jvm.System.gc()
    return out


def _window_key(h: int, d: int, window: bytes) -> int:
    return int.from_bytes(blake2b(window, digest_size=8, salt=(h & (1 << 64) - 1).to_bytes(8, "big"), person=bytes([d])).digest(), "big", signed=True)


def _context_task(crowded):
    """The contexts of a text's anchors; one seen before in the batch comes without its bytes.

    Contexts of grams in ``crowded`` slots come as their windows, each with a key of its own for ``h``.
    """

    def merged(first: dict, seen: list, same: tuple, mine: tuple) -> None:
        """Of equal contexts the earliest keeps its bytes."""
        other = first.setdefault(same, mine)
        if other != mine:
            if mine < other:
                first[same], mine = mine, other
            seen.append((same[0], *mine, None))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first: dict[tuple, tuple] = {}
            parted: dict[tuple, tuple] = {}
            windows: dict[tuple, tuple] = {}
            seen: list[tuple] = []
            ids, keys = batch.column("id").to_pylist(), batch.column("key").to_pylist()
            for i in range(len(batch)):
                text = batch.column("text")[i].as_buffer()
                text = memoryview(text) if text is not None else memoryview(b"")
                marks = batch.column("marks")[i].values
                id_, key = _order(ids[i]), keys[i]
                hashes = marks.field("h").to_numpy()
                many = crowded.value[_slot(hashes)].tolist()
                for h, at, apart in zip(hashes.tolist(), marks.field("at").to_pylist(), many, strict=True):
                    position, low, high = at >> 16, (at >> 8) & 255, at & 255
                    if position - high < 0 or position - low + SPAN > len(text):
                        continue  # of another text under the same key
                    same = (h, at & 0xFFFF, bytes(text[position - high : position - low + SPAN]))
                    merged(parted if apart else first, seen, same, (id_, key, at))
            for (h, reach, ctx), (id_, key, at) in parted.items():
                low, high = reach >> 8, reach & 255
                for d in range(low, high + 1):
                    window = ctx[high - d : high - d + SPAN]
                    one = (d << 8) | d
                    merged(windows, seen, (_window_key(h, d, window), one, window), (id_, key, (at >> 16 << 16) | one))
            made = [(h, *mine, ctx) for x in (first, windows) for (h, _, ctx), mine in x.items()] + seen
            for k in range(0, len(made), TOGETHER):
                columns = zip(*made[k : k + TOGETHER], strict=True)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=_CONTEXT_NAMES)

    return task


def _order(id_: int | None) -> int:
    """Null ids come first."""
    return -(1 << 63) if id_ is None else id_


def blind_trie_order(strings: list[bytes]) -> list[int]:
    """The sorted order of distinct strings of one length, by inserting them into a blind trie.

    A node holds the depth at which its strings part and a child for each byte there; the bytes skipped
    between nodes are not looked at on the way down, but compared once with the leaf that was reached.
    """
    root: list | int = 0
    for i in range(1, len(strings)):
        s = strings[i]
        node = root
        while type(node) is list:
            child = node[1].get(s[node[0]])
            node = child if child is not None else next(iter(node[1].values()))
        x = strings[node]
        differing = int.from_bytes(s, "big") ^ int.from_bytes(x, "big")
        depth = len(s) - (differing.bit_length() + 7) // 8
        above, node = None, root
        while type(node) is list and node[0] < depth:
            above, node = node, node[1][s[node[0]]]
        if type(node) is list and node[0] == depth:
            node[1][s[depth]] = i
            continue
        split = [depth, {s[depth]: i, x[depth]: node}]
        if above is None:
            root = split
        else:
            above[1][s[above[0]]] = split
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if type(node) is list:
            stack.extend(child for _, child in sorted(node[1].items(), reverse=True))
        else:
            out.append(node)
    return out


def deep_shallow_sort(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort the rows of a byte matrix within their groups (ascending numbers).

    Returns the order, and for each place in it the common prefix with the place before: -1 at a group's first.
    """
    characters = rows.view(">u8").astype(np.uint64)
    order = np.argsort(group, kind="stable")
    cls = group[order].astype(np.int64)
    head = np.concatenate([[True], cls[1:] != cls[:-1]]) if len(cls) else np.zeros(0, bool)
    first = head.copy()
    # Shallow: split the classes of more than one row by their next character.
    for k in range(SHALLOW // 8):
        number = np.cumsum(head) - 1
        open_ = np.flatnonzero(np.bincount(number, minlength=1)[number] > 1)
        if not len(open_):
            break
        word = characters[order[open_], k]
        by = np.lexsort((word, number[open_]))
        order[open_] = order[open_][by]
        word, number = word[by], number[open_]
        head[open_[1:]] |= (word[1:] != word[:-1]) & (number[1:] == number[:-1])
    # Deep: what is equal so far and differs later goes through blind tries.
    places = np.flatnonzero(head)
    stops = np.concatenate([places[1:], [len(order)]])
    leader = characters[order[np.repeat(places, stops - places)]]
    differs = np.add.reduceat((characters[order] != leader).any(axis=1), places) > 0 if len(places) else []
    for a, b in zip(places[differs], stops[differs], strict=True) if len(places) else ():
        copies: dict[bytes, list[int]] = {}
        for i in order[a:b]:
            copies.setdefault(rows[i].tobytes(), []).append(i)
        strings = list(copies)
        order[a:b] = [i for s in blind_trie_order(strings) for i in copies[strings[s]]]
    common = np.full(len(order), -1, np.int64)
    if len(order) > 1:
        unequal = rows[order[1:]] != rows[order[:-1]]
        common[1:] = np.where(unequal.any(axis=1), unequal.argmax(axis=1), rows.shape[1])
    common[first] = -1
    return order, common


def _side(contexts: list[bytes], low: np.ndarray, high: np.ndarray, *, right: bool) -> np.ndarray:
    """The bytes on one side of each anchor, outwards, as a matrix; no byte is 0, but what follows the end is."""
    width = SPAN + 4 if right else (REACH + 7) // 8 * 8
    length = SPAN - low if right else high
    flat = np.frombuffer(b"".join(contexts), np.uint8)
    sizes = SPAN + high - low
    anchor = np.cumsum(sizes) - sizes + high
    step = np.arange(width)
    index = anchor[:, None] + step if right else anchor[:, None] - 1 - step
    within = step < length[:, None]
    return np.where(within, flat[np.where(within, index, 0)] + np.uint8(1), np.uint8(0))


def repeated(h: np.ndarray, rank: np.ndarray, low: np.ndarray, high: np.ndarray, contexts: list[bytes]) -> np.ndarray:
    """For each context and distance: has the window that starts so far left of the anchor an earlier equal?

    ``rank`` orders the contexts by text and position; contexts of one gram have one ``h``.
    """
    group = np.unique(h, return_inverse=True)[1]
    right, right_common = deep_shallow_sort(_side(contexts, low, high, right=True), group)
    left, left_common = deep_shallow_sort(_side(contexts, low, high, right=False), group)
    n = len(h)
    out = np.zeros((n, REACH + 1), bool)
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(REACH + 1):
        active = np.flatnonzero((low <= d) & (d <= high))
        if len(active) < 2:
            continue
        right_class[right] = np.cumsum(right_common < SPAN - d)
        left_class[left] = np.cumsum(left_common < d)
        window = right_class[active] * (n + 1) + left_class[active]
        by = np.lexsort((rank[active], window))
        window, who = window[by], active[by]
        head = np.concatenate([[True], window[1:] != window[:-1]])
        out[who, d] = rank[who] > rank[who[np.maximum.accumulate(np.where(head, np.arange(len(who)), 0))]]
    return out


def _repeat_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts in order of their grams become the byte ranges that are repeated."""

    def spans(key, position, low, high):
        return pa.RecordBatch.from_arrays(
            [pa.array(key, pa.int64()), pa.array(position - high, pa.int64()), pa.array(position - low + SPAN, pa.int64())],
            names=["key", "start", "stop"],
        )

    def settle(part: pa.Table) -> Iterator[pa.RecordBatch]:
        known = pa.compute.is_valid(part.column("ctx"))
        at = part.column("at").to_numpy()
        position, low, high = at >> 16, (at >> 8) & 255, at & 255
        key, id_, h = part.column("key").to_numpy(), part.column("id").to_numpy(), part.column("h").to_numpy()
        keep = known.to_numpy()
        yield spans(key[~keep], position[~keep], low[~keep], high[~keep])
        if keep.sum() < 2:
            return
        key, id_, h, position, low, high = (x[keep] for x in (key, id_, h, position, low, high))
        contexts = part.column("ctx").filter(known).to_pylist()
        by = np.lexsort((position, key, id_))
        same = (position[by][1:] == position[by][:-1]) & (key[by][1:] == key[by][:-1]) & (id_[by][1:] == id_[by][:-1])
        rank = np.empty(len(by), np.int64)
        rank[by] = np.concatenate([[0], np.cumsum(~same)])
        found = repeated(h, rank, low, high, contexts)
        edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        who, least = np.nonzero(edge == 1)
        most = np.nonzero(edge == -1)[1] - 1
        yield spans(key[who], position[who], least, most)

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows < TOGETHER:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        h = table.column("h").to_numpy()
        cut = int(np.searchsorted(h, h[-1]))  # the last gram may go on
        if cut:
            yield from settle(table.slice(0, cut))
        held, rows = table.slice(cut).to_batches(), len(h) - cut
    if rows:
        yield from settle(pa.Table.from_batches(held).combine_chunks())


def _kept_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        text, spans, first = batch.column("text"), batch.column("spans"), batch.column("first").to_pylist()
        for i in range(len(batch)):
            data = memoryview(text[i].as_buffer()) if text[i].is_valid else memoryview(b"")
            n = len(data)
            if not first[i]:
                ranges = [(0, n)] if n >= SPAN else []
            elif spans[i].is_valid:
                ranges = sorted(zip(spans[i].values.field("start").to_pylist(), spans[i].values.field("stop").to_pylist(), strict=True))
            else:
                ranges = []
            digest, done, removed, runs = sha256(), 0, 0, 0
            kept: list[bytes] = []
            for start, stop in ranges:
                if start > done or not runs:
                    runs += 1
                    kept.append(bytes(data[done:start]))
                    done = start
                if stop > done:
                    removed += stop - done
                    done = stop
            kept.append(bytes(data[done:]))
            for piece in kept:
                digest.update(piece)
            out.append((n, removed, runs, digest.hexdigest(), b"".join(kept)))
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]],
            names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def contexts_of(originals: DataFrame, crowded: np.ndarray) -> DataFrame:
    """``(h, id, key, at, ctx)``: the contexts of repeated grams, under the key by which they meet."""
    crowded = originals.sparkSession.sparkContext.broadcast(crowded)
    # All columns go each way, so that the texts are shuffled once and read again.
    marks = originals.mapInArrow(_anchor_task, "h long, salt long, key long, at long").repartition("h", "salt")
    marks = marks.sortWithinPartitions("h", "salt").mapInArrow(_often_task, "h long, key long, at long")
    marks = marks.groupBy("key").agg(F.collect_list(F.struct("h", "at")).alias("marks"))
    return originals.join(marks.hint("shuffle_hash"), "key").mapInArrow(_context_task(crowded), _CONTEXT)


def without_repeats(documents: DataFrame) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256, kept)`` for every row of ``documents (id long, text)``.

    A null text is empty; texts under ``SPAN`` bytes are never touched. Null ids come before all others. Of
    equal texts the one with the smallest id is the first. Rows equal in id and text count as one document:
    each gets the same result. Further columns are ignored.
    """
    rows = documents.select(F.col("id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    named = rows.select("id", "text", F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    named = named.select("id", "text", "sha", F.xxhash64("id", "sha").alias("key"))
    # The first of equal texts, found on digests.
    first = named.groupBy("sha").agg(F.min(F.struct("id", "key")).alias("one")).select(F.col("one.key").alias("key"), F.lit(True).alias("first"))
    spread = named.select("key", "id", "text").repartition("key")
    originals = spread.join(first.hint("shuffle_hash"), "key").select("key", "id", "text")

    contexts = contexts_of(originals, crowded_slots(rows))
    # What is settled already goes its own way; it does not crowd in with its gram.
    spread_out = F.when(F.col("ctx").isNull(), F.col("key")).otherwise(F.lit(0))
    spans = contexts.repartition(F.col("h"), spread_out).sortWithinPartitions("h").mapInArrow(_repeat_task, "key long, start long, stop long")
    spans = spans.groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))

    out = spread.join(first.hint("shuffle_hash"), "key", "left").join(spans.hint("shuffle_hash"), "key", "left")
    return out.mapInArrow(_kept_task, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
