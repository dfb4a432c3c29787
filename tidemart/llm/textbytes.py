"""Vectorised work on the UTF-8 bytes of a column of texts, for use inside Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Texts are taken in blocks of about so many bytes; one longer text is a block of its own.
BLOCK_BYTES = 2_000_000
# Where a block's arrays are many times its bytes: a worker keeps the room of the largest that it ever took.
SMALL_BLOCK_BYTES = 250_000

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))

# White space is \x20 and \x09 to \x0D.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_POWERS: dict[str, np.ndarray] = {}


def powers(name: str, n: int) -> np.ndarray:
    """1, b, b^2, ... modulo 2^64, for b the base or its inverse."""
    held = _POWERS.get(name)
    if held is None or len(held) < n:
        b = BASE if name == "base" else INVERSE
        size = n if n > 4 * BLOCK_BYTES else 1 << max(18, (n - 1).bit_length())
        held = np.full(size, b, np.uint64)
        held[0] = 1
        held = np.multiply.accumulate(held)
        if n <= 4 * BLOCK_BYTES:
            _POWERS[name] = held
    return held[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A full mix of 64-bit values, in a new array."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def blocks(column: pa.Array, most: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows of ``most`` bytes, by default ``BLOCK_BYTES``; a null text is empty."""
    most = BLOCK_BYTES if most is None else most
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pa.compute.fill_null(column, b"")
    if not len(column):
        return
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(ends, ends[row] + most, "right")) - 1
        stop = min(max(stop, row + 1), len(column))
        yield row, data[ends[row] : ends[stop]], ends[row : stop + 1] - ends[row]
        row = stop


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and how many words begin before each text's start (n + 1 values)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    solid = ~SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    starts_text = offsets[:-1][offsets[:-1] < len(data)]
    first[starts_text] = solid[starts_text]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | first[1:]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, the same wherever the span lies."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers("base", n), out=sums[1:])
    raw = (sums[ends] - sums[starts]) * powers("inverse", n + 1)[starts]
    return mixed(raw + (ends - starts).astype(np.uint64))
