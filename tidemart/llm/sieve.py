"""A bitmap of 64-bit marks, sent to tasks to tell most rows that nobody asked for from those that somebody did."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bits for each mark: one foreign row in so many passes. At most 2^MOST_BITS bits (128 MB) are sent; with more marks
# than fit, more foreign rows pass, and the join that follows takes them out.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 16, 30


def bitmap(marks: DataFrame) -> tuple[np.ndarray, int]:
    """The words of the bitmap of ``marks (mark long)``, and of how many leading bits its places are."""
    many = marks.count()
    bits = min(max(LEAST_BITS, math.ceil(math.log2(BITS_EACH * many + 1))), MOST_BITS)
    place = F.shiftrightunsigned("mark", 64 - bits)
    one = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(mark, {64 - bits}) & 63 as int))")
    found = marks.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint64), bits


def passes(held: tuple[np.ndarray, int], marks: np.ndarray) -> np.ndarray:
    """Which of some marks, as unsigned 64-bit numbers, may be among those in the bitmap."""
    words, bits = held
    place = marks >> np.uint64(64 - bits)
    return (words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0
