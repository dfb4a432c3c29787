"""Seeded random draws as column expressions.

A draw is a hash of (seed, label, row number): the same for any partitioning, any order and
any retry of a task, and independent between labels.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


class Draws:
    """Draws for the thing with number ``number`` (and, within it, part ``part``)."""

    def __init__(self, number: Column, seed: int, part: Column | None = None):
        self._inputs = [number] if part is None else [number, part]
        self._seed = seed

    def bits(self, label: str) -> Column:
        return F.xxhash64(F.lit(self._seed), F.lit(label), *self._inputs)

    def unit(self, label: str) -> Column:
        """Uniform double in [0, 1)."""
        return F.shiftrightunsigned(self.bits(label), 11).cast("double") * F.lit(2.0**-53)

    def whole(self, label: str, low: int, high) -> Column:
        """Uniform integer from ``low`` to ``high``, both included."""
        span = F.lit(high) - low + 1
        return (F.floor(self.unit(label) * span) + low).cast("int")

    def number_below(self, label: str, count) -> Column:
        """Uniform number from 0 to ``count`` - 1, for counts of any size."""
        return F.floor(self.unit(label) * F.lit(count)).cast("long")

    def real(self, label: str, low: float, high: float) -> Column:
        return self.unit(label) * F.lit(float(high - low)) + F.lit(float(low))

    def amount(self, label: str, low: float, high: float, digits: int = 2) -> Column:
        """Uniform decimal with so many digits after the point."""
        return F.round(self.real(label, low, high), digits).cast(f"decimal(10,{digits})")

    def pick(self, label: str, values: list) -> Column:
        return F.element_at(F.lit(values), self.whole(label, 1, len(values)))

    def weighted(self, label: str, weights: dict) -> Column:
        """One of the keys, with probability in proportion to its weight."""
        total, passed, choice = sum(weights.values()), 0.0, None
        draw = self.unit(label)
        *firsts, last = weights
        for value in firsts:
            passed += weights[value]
            below = draw < F.lit(passed / total)
            choice = F.when(below, F.lit(value)) if choice is None else choice.when(below, F.lit(value))
        return choice.otherwise(F.lit(last))

    def _hex(self, label: str) -> Column:
        return F.lower(F.lpad(F.hex(self.bits(label)), 16, "0"))

    def short_id(self, label: str) -> Column:
        return F.substring(self._hex(label), 1, 8)

    def long_id(self, label: str) -> Column:
        """128 bits in the usual 8-4-4-4-12 form."""
        high, low = self._hex(f"{label}/high"), self._hex(f"{label}/low")
        pieces = (high, 1, 8), (high, 9, 4), (high, 13, 4), (low, 1, 4), (low, 5, 12)
        return F.concat_ws("-", *[F.substring(text, start, n) for text, start, n in pieces])

    def ip(self, label: str) -> Column:
        parts = [self.whole(f"{label}/{i}", 1, 254).cast("string") for i in range(4)]
        return F.concat_ws(".", *parts)
