"""Whitening of embeddings by the exact characteristic polynomial of their integer scatter matrix.

1. The scatter matrix ``n * sum(x x') - S S'``, n^2 times the covariance, is added up exactly: in a task by float
   products of 20-bit limbs that stay below 2^53, between tasks as sums of 60-bit digits.
2. Its characteristic polynomial is found modulo as many 31-bit primes as its coefficients can need, one
   Hessenberg reduction a prime, the primes dealt to tasks; the Chinese remainder theorem gives the integers.
3. All roots are real, so Descartes' rule of signs on shifted polynomials counts roots above any number exactly, also repeated
   ones. Bisection brings the largest eigenvalues to 128 bits of the trace.
4. For each of them inverse iteration in 80 decimal digits finds its null space, one task an eigenvalue.

What the driver holds is bounded by the square of the dimension, not by the rows; so is what a task sends: of each
pair of dimensions a few longs.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.tables import settled

# Fixed values of the contract: x = floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
# Scaled entries from here on do not fit a long with all that is done to them; their rows take no part.
TOO_LARGE = 2.0**61

LIMB, BLOCK_ROWS = 20, 4096  # limbs of two entries and the sum over a block stay exact in doubles
DIGIT = 60
ROOT_BITS = 128
DIGITS = decimal.Context(prec=80, Emax=decimal.MAX_EMAX, Emin=decimal.MIN_EMIN)


# --- the scatter matrix ---


def usable(vector: Column) -> Column:
    """The vector as doubles; null where it is null or holds null, non-finite or too large entries."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    odd = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) * SCALE >= TOO_LARGE))
    return F.when(vector.isNotNull() & ~odd, doubles)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, floor(SCALE * c) as integers) for runs of rows of equal width."""
    column = batch.column("v")
    width = len(column[0]) if len(column) else 0
    values = np.floor(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width) * SCALE).astype(np.int64)
    for a in range(0, len(values), BLOCK_ROWS):
        yield a, values[a : a + BLOCK_ROWS]


def limbs(values: np.ndarray) -> list[np.ndarray]:
    """Doubles whose sum, each times 2^LIMB more than the one before, gives the values."""
    out, half = [], 1 << (LIMB - 1)
    while values.size and (values.min() < -half or values.max() >= half):
        out.append((values & ((1 << LIMB) - 1)).astype(float))
        values = values >> LIMB
    return [*out, values.astype(float)]


def products(values: np.ndarray) -> np.ndarray:
    """values' values, exactly, as Python integers."""
    parts, total = limbs(values), 0
    for i, a in enumerate(parts):
        for j, b in enumerate(parts):
            total = total + ((a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j)))
    return total


def _digits(number: int) -> list[int]:
    """Base 2^DIGIT, lowest first; the last one carries the sign."""
    out = []
    while not -(1 << DIGIT) <= number < 1 << DIGIT:
        out.append(number & ((1 << DIGIT) - 1))
        number >>= DIGIT
    return [*out, number]


def _scatter_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(i, j, digit, value) of the sums of products; j is -1 for plain sums, and i too for the number of rows."""
    n, sums, squares = 0, None, None
    for batch in batches:
        for _, values in _blocks(batch):
            n += len(values)
            one = products(values)
            plain = sum(x.sum(axis=0).astype(np.int64).astype(object) << (LIMB * k) for k, x in enumerate(limbs(values)))
            sums, squares = (plain, one) if sums is None else (sums + plain, squares + one)
    if not n:
        return
    rows = [(-1, -1, 0, n)]
    for i in range(len(sums)):
        rows += [(i, -1, k, x) for k, x in enumerate(_digits(int(sums[i])))]
        for j in range(i, len(sums)):
            rows += [(i, j, k, x) for k, x in enumerate(_digits(int(squares[i, j])))]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["i", "j", "digit", "value"])


def scatter(rows: DataFrame, width: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, n * products - sums sums') of the integer vectors; ``rows`` has doubles of that width as ``v``."""
    parts = rows.select("v").mapInArrow(_scatter_task, "i long, j long, digit long, value long")
    found = parts.groupBy("i", "j", "digit").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    n, sums, squares = 0, [0] * width, [[0] * width for _ in range(width)]
    for i, j, digit, value in found:  # a few rows for each pair of dimensions
        value = int(value) << (DIGIT * digit)
        if i < 0:
            n += value
        elif j < 0:
            sums[i] += value
        else:
            squares[i][j] += value
    whole = [[n * squares[min(i, j)][max(i, j)] - sums[i] * sums[j] for j in range(width)] for i in range(width)]
    return n, sums, whole


# --- the characteristic polynomial ---


def is_prime(n: int) -> bool:
    """Exact for n below 3 * 10^9."""
    if n < 2 or n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if n == base or x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes(bits: int) -> list[int]:
    """Primes below 2^31 whose product has more than so many bits."""
    out, have, p = [], 0.0, (1 << 31) - 1
    while have <= bits + 1:
        if is_prime(p):
            out.append(p)
            have += math.log2(p)
        p -= 2
    return out


def polynomial_bits(matrix: list[list[int]]) -> int:
    """The coefficients' size: elementary symmetric functions of non-negative numbers that add up to the trace."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    # The k-th is at most binomial(d, k) * (trace / d)^k.
    each = max(0.0, trace.bit_length() - math.log2(max(d, 1)) + 1)
    return 2 + max((math.ceil(math.comb(d, k).bit_length() + k * each) for k in range(d + 1)), default=0)


def polynomial_modulo(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(xI - matrix) modulo a prime below 2^31, lowest first, by reduction to Hessenberg form."""
    d = len(matrix)
    h = np.array([[x % p for x in row] for row in matrix], np.int64).reshape(d, d)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        h[[k + 1, pivot]] = h[[pivot, k + 1]]
        h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        factor = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factor[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factor % p).sum(axis=1)) % p
    known = np.zeros((d + 1, d + 1), np.int64)  # of the leading minors
    known[0, 0] = 1
    for k in range(1, d + 1):
        new = np.roll(known[k - 1], 1)
        new = (new - known[k - 1] * h[k - 1, k - 1]) % p
        path = 1
        for i in range(k - 1, 0, -1):
            path = path * int(h[i, i - 1]) % p
            if not path:
                break
            new = (new - known[i - 1] * (path * int(h[i - 1, k - 1]) % p)) % p
        known[k] = new
    return known[d].tolist()


def _polynomial_task(matrix):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = batch.column("p").to_pylist()
            found = [polynomial_modulo(matrix.value, p) for p in chosen]
            yield pa.RecordBatch.from_arrays([pa.array(chosen, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["p", "found"])

    return task


def joined_residues(found: list[tuple[int, list[int]]]) -> list[int]:
    """The integers, of either sign, that leave these remainders."""
    product = math.prod(p for p, _ in found)
    weights = [(product // p) * pow(product // p, -1, p) for p, _ in found]
    out = []
    for k in range(len(found[0][1])):
        x = sum(w * r[k] for w, (_, r) in zip(weights, found, strict=True)) % product
        out.append(x - product if x > product // 2 else x)
    return out


# --- its roots ---


def _shifted(coefficients: list[int], by: int) -> list[int]:
    """Coefficients of P(x + by), lowest first."""
    c = list(coefficients)
    for i in range(len(c) - 1):
        for k in range(len(c) - 2, i - 1, -1):
            c[k] += by * c[k + 1]
    return c


def roots_above(coefficients: list[int], by: int) -> int:
    """How many roots, counted as often as they repeat, lie above an integer; all roots must be real."""
    signs = [x > 0 for x in _shifted(coefficients, by) if x]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def largest_roots(coefficients: list[int], many: int) -> tuple[list[int], int]:
    """The largest roots of a monic polynomial whose roots are real and not negative, falling, times 2^bits and rounded up, and the bits.

    A root that is exactly 0 is given as 0; equal roots are given equal.
    """
    d = len(coefficients) - 1
    trace = -coefficients[d - 1] if d else 0
    bits = max(0, ROOT_BITS - trace.bit_length())
    scaled = [c << (bits * (d - k)) for k, c in enumerate(coefficients)]
    seen = {0: roots_above(scaled, 0), (trace << bits) + 1: 0}

    def above(x: int) -> int:
        if x not in seen:
            seen[x] = roots_above(scaled, x)
        return seen[x]

    out = []
    for k in range(1, min(many, d) + 1):
        if above(0) < k:
            out.append(0)
            continue
        low, high = max(x for x, n in seen.items() if n >= k), min(x for x, n in seen.items() if n < k)
        while high - low > 1 and (seen[low] != k or seen[high] != k - 1):
            middle = (low + high) // 2
            low, high = (middle, high) if above(middle) >= k else (low, middle)
        if high - low > 1:  # one root alone: the sign tells on which side it is
            value = lambda x: _at(scaled, x)
            rising = value(high) > 0
            while high - low > 1:
                middle = (low + high) // 2
                v = value(middle)
                low, high = (middle, high) if v and (v > 0) != rising else (low, middle)
        out.append(high)
    return out, bits


def _at(coefficients: list[int], x: int) -> int:
    value = 0
    for c in reversed(coefficients):
        value = value * x + c
    return value


# --- its components ---


def null_space(matrix: list[list[int]], root: Fraction, many: int) -> list[list[float]]:
    """Unit vectors, orthogonal to each other, that span the space of a root that repeats so often."""
    with decimal.localcontext(DIGITS):
        d = len(matrix)
        number = decimal.Decimal
        shift = number(root.numerator) / number(root.denominator)
        a = np.array([[number(x) for x in row] for row in matrix], object).reshape(d, d)
        tiny = max(max(abs(x) for x in a.flat), number(1)) * number(10) ** -70
        for i in range(d):
            a[i, i] -= shift
        order = list(range(d))
        for k in range(d):
            pivot = max(range(k, d), key=lambda i: abs(a[i, k]))
            a[[k, pivot]] = a[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            if k + 1 < d:
                a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
                a[k + 1 :, k + 1 :] = a[k + 1 :, k + 1 :] - np.outer(a[k + 1 :, k], a[k, k + 1 :])

        def solved(v: np.ndarray) -> np.ndarray:
            x = v[order].copy()
            for k in range(d):
                x[k + 1 :] = x[k + 1 :] - a[k + 1 :, k] * x[k]
            for k in reversed(range(d)):
                x[k] = (x[k] - (a[k, k + 1 :] * x[k + 1 :]).sum()) / a[k, k]
            return x

        out: list[np.ndarray] = []
        for m in range(many):
            x = np.array([number(1 + (i * i * 7919 + (m + 1) * (i + 1) * 104_729) % 1009) for i in range(d)], object)
            for _ in range(3):
                for _ in range(2):
                    for other in out:
                        x = x - other * (x * other).sum()
                    x = x / (x * x).sum().sqrt()
                x = solved(x)
            for _ in range(2):
                for other in out:
                    x = x - other * (x * other).sum()
                x = x / (x * x).sum().sqrt()
            out.append(x if max(x, key=abs) > 0 else -x)
        return [[float(x) for x in v] for v in out]


def _component_task(matrix, bits: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, many, root in zip(*(batch.column(c).to_pylist() for c in ("first", "many", "root")), strict=True):
                # The middle of the last interval: no root itself, and as near as the bits allow.
                found = null_space(matrix.value, Fraction(2 * int(root) - 1, 2 << bits), many)
                columns = [pa.array(range(first, first + many), pa.int64()), pa.array(found, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["component", "v"])

    return task


# --- whitening ---


def _white_task(n: int, sums: list[int], components: np.ndarray, deviations: np.ndarray):
    """``deviation`` and the projections of each row."""
    most = max((abs(s) for s in sums), default=0)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, values in _blocks(batch):
                small = n * max(int(values.max(initial=0)), -int(values.min(initial=0))) + most < 2**62
                apart = (values if small else values.astype(object)) * n - np.array(sums, np.int64 if small else object)
                furthest = max(int(apart.max(initial=0)), -int(apart.min(initial=0)))
                exact = apart if furthest * furthest * max(1, len(sums)) < 2**62 else apart.astype(object)
                squares = [int(x) for x in (exact * exact).sum(axis=1)]
                white = ((apart / n).astype(float) @ components) / deviations
                columns = [
                    batch.column("id").slice(row, len(values)),
                    pa.array([x if x < 2**63 else None for x in squares], pa.int64()),
                    pa.array(map(str, squares), pa.string()),
                    pa.FixedSizeListArray.from_arrays(pa.array(white.reshape(-1)), white.shape[1]).cast(pa.list_(pa.float64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "deviation", "deviation_exact", "white"])

    return task


def whitened(rows: DataFrame, many: int = 8) -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error, deviation_exact)`` for each row and component.

    ``rows (id, v)``. Vectors that are null, hold null or non-finite entries, or entries of 2^51 and more, take no part; of
    several widths the one most rows have is taken (ties: the smaller). All others are fitted and returned, repeated
    rows and ids each time. There are ``many`` components, or as many as dimensions if these are fewer. One without
    variance has a null ``whitened`` and does not enter ``identity_error``; ``explained`` is null if there is no
    variance at all, ``identity_error`` if no component has any. ``deviation`` is null where it does not fit a long,
    ``deviation_exact`` has its digits always. No rows, or rows without entries: no result. Other columns are ignored.
    """
    spark = rows.sparkSession
    taken = rows.select(F.col("id").cast("long").alias("id"), usable(F.col("v")).alias("v")).where(F.size("v") > 0)
    widths = taken.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), "width").limit(1).collect()
    if not widths:
        schema = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact string"
        return spark.createDataFrame([], schema)
    width = widths[0].width
    taken = taken.where(F.size("v") == width)
    n, sums, whole = scatter(taken, width)
    common = math.gcd(*(x for row in whole for x in row)) or 1
    matrix = [[x // common for x in row] for row in whole]
    sent = spark.sparkContext.broadcast(matrix)

    chosen = primes(polynomial_bits(matrix))
    dealt = spark.createDataFrame([(p,) for p in chosen], "p long").repartition(min(len(chosen), 64))
    residues = dealt.mapInArrow(_polynomial_task(sent), "p long, found array<long>").collect()  # a row for each prime
    polynomial = joined_residues([(r.p, r.found) for r in residues])
    roots, bits = largest_roots(polynomial, many)

    spaces = [(k, roots.count(r), str(r)) for k, r in enumerate(roots) if r and (k == 0 or roots[k - 1] != r)]
    vectors: dict[int, list[float]] = {}
    if spaces:
        dealt = spark.createDataFrame(spaces, "first long, many long, root string").repartition(len(spaces))
        vectors = {r.component: r.v for r in dealt.mapInArrow(_component_task(sent, bits), "component long, v array<double>").collect()}

    trace = sum(matrix[i][i] for i in range(width))
    variance = [Fraction(r * common, n * n << bits) for r in roots]
    explained = [float(Fraction(r, trace << bits)) if trace else None for r in roots]
    components = np.array([vectors.get(k, [0.0] * width) for k in range(len(roots))]).T
    deviations = np.array([math.sqrt(v) if v else 1.0 for v in variance])
    task = _white_task(n, sums, components, deviations)
    white = settled(taken.mapInArrow(task, "id long, deviation long, deviation_exact string, white array<double>"), "white")

    real = [k for k, r in enumerate(roots) if r]
    pairs = [(i, j) for i in real for j in real if i <= j]
    of = lambda k: F.col("white")[k]
    found = white.agg(F.lit(0).alias("x"), *[F.avg(of(i) * of(j)).alias(f"c{i}_{j}") for i, j in pairs], *[F.avg(of(i)).alias(f"m{i}") for i in real]).first()
    errors = [abs(found[f"c{i}_{j}"] - found[f"m{i}"] * found[f"m{j}"] - (i == j)) for i, j in pairs]

    def of_each(values: list) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("double") for v in values]), F.col("pos") + 1)

    out = white.select("id", "deviation", "deviation_exact", F.posexplode("white").alias("pos", "value"))
    return out.select(
        "id",
        (F.col("pos") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        F.when(F.col("pos").isin(real), F.col("value")).alias("whitened"),
        of_each(explained).alias("explained"),
        F.lit(max(errors, default=None)).cast("double").alias("identity_error"),
        "deviation_exact",
    )
