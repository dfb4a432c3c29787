"""Whitening against exact fractions and a plain eigensolver."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from tidemart.llm import whitening
from tidemart.llm.queries import QUERIES


def brute(rows, many=8):
    """By id: (n, deviation, |whitened|, explained), with numpy's eigensolver on the exact covariance."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)]
    xs = [[math.floor(1024 * Fraction(x)) + 100_000 for x in v] for _, v in kept]
    n, d = len(xs), len(xs[0])
    s = [sum(x[k] for x in xs) for k in range(d)]
    exact = [[Fraction(n * sum(x[i] * x[j] for x in xs) - s[i] * s[j], n * n) for j in range(d)] for i in range(d)]
    e, p = np.linalg.eigh(np.array(exact, float))
    e, p = e[::-1][:many], p[:, ::-1][:, :many]
    out = []
    for (i, _), x in zip(kept, xs, strict=True):
        centred = np.array([float(Fraction(n * x[k] - s[k], n)) for k in range(d)])
        out.append((i, n, sum((n * x[k] - s[k]) ** 2 for k in range(d)), centred @ p / np.sqrt(np.maximum(e, 1e-300)), e / np.trace(np.array(exact, float))))
    return out


def by_row(frame):
    rows = {}
    for r in frame.collect():
        rows.setdefault((r.id, r.deviation_exact), []).append(r)
    return {k: sorted(v, key=lambda r: r.component) for k, v in rows.items()}


@pytest.mark.parametrize("width", [1, 3, 12, 40])
def test_same_as_an_eigensolver(shipped, width):
    rng = np.random.default_rng(width)
    mix = rng.normal(size=(width, width)) * np.linspace(2, 0.2, width)
    rows = [(i, [float(x) for x in rng.normal(size=width) @ mix]) for i in range(300)]
    got = by_row(whitening.whitened(shipped.createDataFrame(rows, "id long, v array<double>").repartition(4)))
    for i, n, deviation, white, explained in brute(rows):
        mine = got[i, str(deviation)]
        assert [r.component for r in mine] == list(range(1, min(8, width) + 1))
        assert all((r.n, r.deviation) == (n, deviation) and r.identity_error < 1e-9 for r in mine)
        assert np.allclose([r.explained for r in mine], explained, rtol=1e-9)
        assert np.allclose(np.abs([r.whitened for r in mine]), np.abs(white), atol=1e-7)


def test_signs_are_the_same_for_all_rows(shipped):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=6) * [6, 5, 4, 3, 2, 1]]) for i in range(200)]
    got = by_row(whitening.whitened(shipped.createDataFrame(rows, "id long, v array<double>"), many=3))
    white = np.array([[r.whitened for r in got[i, str(d)]] for i, _, d, _, _ in brute(rows)])
    plain = np.array([w for *_, w, _ in brute(rows, 3)])
    for k in range(3):
        assert np.allclose(white[:, k], plain[:, k], atol=1e-7) or np.allclose(white[:, k], -plain[:, k], atol=1e-7)


def test_repeated_and_missing_variance(shipped):
    """Two equal eigenvalues, one single, and directions without variance."""
    corners = [(a, b, c) for a in (-1, 1) for b in (-1, 1) for c in (-1, 1)]
    rows = [(i, [a * 2.0, b * 2.0, c * 1.0, 0.5, c * 1.0]) for i, (a, b, c) in enumerate(corners * 3)]
    found = whitening.whitened(shipped.createDataFrame(rows, "id long, v array<double>"), many=5).collect()
    assert {r.component: round(r.explained, 12) for r in found} == {1: 0.4, 2: 0.4, 3: 0.2, 4: 0.0, 5: 0.0}
    assert all((r.whitened is None) == (r.component > 3) and r.identity_error < 1e-12 for r in found)


def test_odd_rows(shipped):
    nan, far = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, []), (4, [nan, 1.0]), (5, [far, 1.0]), (6, [None, 1.0]), (7, [1e300, 0.0]), (None, [0.5, -2.0]), (8, [3.0])]
    frame = shipped.createDataFrame([(*r, 0, 0, "x") for r in rows], "id long, v array<double>, n int, component int, white string")
    found = whitening.whitened(frame).collect()
    assert sorted(((r.id, r.component) for r in found), key=str) == sorted([(1, 1), (1, 1), (1, 2), (1, 2), (None, 1), (None, 2)], key=str)
    assert {r.n for r in found} == {3}
    assert whitening.whitened(frame.where("false")).collect() == [] == whitening.whitened(frame.where("id = 3")).collect()
    same = whitening.whitened(frame.where("id = 1")).collect()
    assert all((r.deviation, r.whitened, r.explained, r.identity_error) == (0, None, None, None) for r in same)


def test_large_entries_stay_exact(shipped):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * 2.0**rng.choice([5, 30, 48]) for _ in range(3)]) for i in range(50)]
    found = by_row(whitening.whitened(shipped.createDataFrame(rows, "id long, v array<double>").repartition(3)))
    for i, _, deviation, _, _ in brute(rows):
        mine = found[i, str(deviation)]
        assert mine[0].deviation == (deviation if deviation < 2**63 else None)
        assert mine[0].identity_error < 1e-9


def test_polynomial_by_remainders():
    rng = np.random.default_rng(1)
    for d in (1, 2, 5, 9):
        a = rng.integers(-9, 9, (d, d + 2))
        a[:, 0] = 0
        m = (a @ a.T).tolist()
        found = [(p, whitening.polynomial_modulo(m, p)) for p in whitening.primes(whitening.polynomial_bits(m))]
        assert np.allclose(whitening.joined_residues(found)[::-1], np.poly(np.array(m, float)), rtol=1e-8)


def test_close_roots_are_told_apart():
    """(x - 10^12)(x - 10^12 - 1)(x - 5)^2 x"""
    roots = [10**12 + 1, 10**12, 5, 5, 0]
    coefficients = [1]
    for r in roots:
        coefficients = [(coefficients[k - 1] if k else 0) - r * (coefficients[k] if k < len(coefficients) else 0) for k in range(len(coefficients) + 1)]
    found, bits = whitening.largest_roots(coefficients, 5)
    assert found == [r << bits for r in roots]


def test_given_embeddings(shipped):
    from tests.conftest import TINY

    rows = [(r.vec_id, r.embedding) for r in shipped.read.parquet(f"{TINY}/embeddings.parquet").collect()]
    found = {(r.vec_id, r.component): r for r in QUERIES["op12_embedding_whitening"](shipped, TINY).collect()}
    want = brute([(i, v and [float(x) for x in v]) for i, v in rows])
    assert len(found) == 8 * len(want)
    for i, n, deviation, white, explained in want:
        for k in range(8):
            r = found[i, k + 1]
            assert (r.n, r.deviation) == (n, deviation) and r.identity_error < 1e-9
            assert abs(r.explained - explained[k]) < 1e-9 and abs(abs(r.whitened) - abs(white[k])) < 1e-6
