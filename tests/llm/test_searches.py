import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemart.llm import bitsliced, neighbours
from tidemart.llm.queries import QUERIES

ODD = [(1000, None), (1001, []), (1002, [None, 1.0, 1.0, 1.0]), (1003, [float("nan")] * 4), (1004, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0, 2.0, 3.0, 4.0])]


def exact(ids, vectors, k, queries, clean=True):
    out = []
    for q in queries:
        scores = vectors @ vectors[q]
        others = [i for i in range(len(ids)) if ids[i] != ids[q]]
        best = sorted(others, key=lambda i: (-scores[i], ids[i]))[:k]
        out += [(ids[q], r + 1, ids[i], scores[i]) for r, i in enumerate(best)]
    return sorted(out)


def vectors_of(n, width, seed, copies=0):
    random = np.random.default_rng(seed)
    made = random.normal(size=(n, width)).astype(np.float32)
    if copies:
        made[-copies:] = made[0]
    return made


def frame(spark, made, extra=()):
    rows = [(i, [float(x) for x in v], 1, 2) for i, v in enumerate(made)] + [(*r, 1, 2) for r in extra]
    return spark.createDataFrame(rows, "id long, v array<float>, leaf int, block int")


@pytest.mark.parametrize(("n", "width", "copies"), [(1, 3, 0), (15, 4, 0), (700, 4, 300), (900, 16, 0)])
def test_bit_sliced_matches_brute_force(shipped, n, width, copies):
    made = vectors_of(n, width, n, copies)
    rows = frame(shipped, made, ODD if width == 4 else ()).withColumn("v", bitsliced.quantised(F.col("v")))
    got = sorted(tuple(r) for r in bitsliced.top(rows, rows.where("id % 20 = 0"), 20).collect())
    whole = np.floor(64 * made.astype(np.float64)).astype(np.int64)
    assert got == exact(list(range(n)), whole, 20, range(0, n, 20))


def test_bit_sliced_over_blocks(shipped, monkeypatch):
    monkeypatch.setattr(bitsliced, "BLOCK_ROWS", 64)
    monkeypatch.setattr(bitsliced, "QUERY_ROWS", 8)
    made = vectors_of(500, 5, 1, 150)
    rows = frame(shipped, made).withColumn("v", bitsliced.quantised(F.col("v")))
    got = sorted(tuple(r) for r in bitsliced.top(rows, rows.where("id % 20 = 0"), 20).collect())
    assert got == exact(list(range(500)), np.floor(64 * made.astype(np.float64)).astype(np.int64), 20, range(0, 500, 20))


def test_bit_sliced_large_components(shipped):
    rows = shipped.createDataFrame([(i, [(-1) ** i * (i * 7919 % 1_000_003), i - 50]) for i in range(100)], "id long, v array<long>")
    values = np.array([r.v for r in rows.orderBy("id").collect()])
    got = sorted(tuple(r) for r in bitsliced.top(rows, rows.where("id % 20 = 0"), 5).collect())
    assert got == exact(list(range(100)), values, 5, range(0, 100, 20))


def test_nothing_to_search(shipped):
    rows = shipped.createDataFrame([], "id long, v array<double>")
    whole = rows.withColumn("v", bitsliced.quantised(F.col("v")))
    assert bitsliced.top(whole, whole, 20).collect() == []
    assert neighbours.nearest(rows, rows, 20).collect() == []


def test_add_up_and_select():
    random.seed(5)
    values = np.array([[random.randrange(-40, 40) for _ in range(6)] for _ in range(130)])
    weights = np.array([[random.randrange(-40, 40) for _ in range(6)] for _ in range(7)])
    index, low = bitsliced.slices(values)
    digits = bitsliced.add_up(index, weights)
    sums = sum(np.unpackbits(d.view(np.uint8), axis=1, count=130, bitorder="little").astype(np.int64) << k for k, d in enumerate(digits))
    top = index.shape[1]
    shifted = values - low
    want = [[sum(abs(w) * (x if w >= 0 else (1 << top) - 1 - x) for w, x in zip(q, v, strict=True)) for v in shifted] for q in weights]
    assert sums.tolist() == want


def recall(found, truth):
    best = {}
    for q, _, v, _ in truth:
        best.setdefault(q, set()).add(v)
    hits = sum(v in best[q] for q, _, v, _ in found)
    return hits / len(truth)


def test_forest_on_given_embeddings(shipped):
    folder = "/root/testdata/sf0.1"
    found = [tuple(r) for r in QUERIES["op5_projection_forest"](shipped, folder).collect()]
    rows = shipped.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").toPandas()
    vectors = np.stack(rows.embedding.to_numpy()).astype(np.float64)
    ids = rows.vec_id.tolist()
    truth = exact(ids, vectors, 20, [i for i in range(len(ids)) if ids[i] % 20 == 0])
    assert recall(found, truth) >= 0.9
    scores = {(q, v): s for q, _, v, s in found}
    place = {v: i for i, v in enumerate(ids)}
    assert all(abs(s - vectors[place[q]] @ vectors[place[v]]) < 1e-9 for (q, v), s in scores.items())
    assert len(found) == len(truth)


@pytest.mark.parametrize(("n", "width", "copies"), [(1, 4, 0), (12, 4, 0), (900, 4, 400)])
def test_small_forests_are_exact(shipped, n, width, copies):
    made = vectors_of(n, width, n, copies)
    zero = [(2000, [0.0] * 4), (2001, [1.0, 2.0])]
    rows = frame(shipped, made, ODD + zero)
    found = sorted(tuple(r) for r in neighbours.nearest(rows, rows.where("id % 20 = 0"), 20, probes=10**6).collect())
    truth = exact(list(range(n)), made.astype(np.float64), 20, range(0, n, 20))
    assert [f[:3] for f in found] == [t[:3] for t in truth]


def test_leaves_in_parts(shipped, monkeypatch):
    monkeypatch.setattr(neighbours, "PART_ROWS", 50)
    made = vectors_of(600, 6, 3)
    rows = frame(shipped, made)
    found = sorted(tuple(r) for r in neighbours.nearest(rows, rows.where("id % 20 = 0"), 20, probes=10**6).collect())
    assert [f[:3] for f in found] == [t[:3] for t in exact(list(range(600)), made.astype(np.float64), 20, range(0, 600, 20))]


def test_every_vector_is_indexed():
    made = vectors_of(2000, 8, 9).astype(np.float64)
    forest = neighbours.Forest(made[:500], float(np.linalg.norm(made, axis=1).max()), 4, 20)
    leaves = forest.leaves_of(made)
    assert leaves.shape == (2000, 4) and leaves.min() >= 0 and leaves.max() < forest.leaves
    everywhere = next(iter(forest.search(made[:1], 10**6)))
    assert sorted(everywhere) == list(range(forest.leaves))


@pytest.mark.parametrize("n", [2_000, 6_000, 20_000])
def test_recall_where_few_of_the_leaves_are_visited(shipped, monkeypatch, n):
    """Small leaves and few probes to begin with: as in a large table, a fixed number would see a small share."""
    monkeypatch.setattr(neighbours, "FITTED", 64)
    made = vectors_of(n, 24, n)
    made /= np.linalg.norm(made, axis=1, keepdims=True)
    rows = shipped.createDataFrame([(i, v.tolist()) for i, v in enumerate(made)], "id long, v array<float>")
    asked = rows.where(f"id % {n // 200} = 0")
    found = [tuple(r) for r in neighbours.nearest(rows, asked, 20, leaf_rows=32, probes=20, sample=1_000).collect()]
    vectors = made.astype(np.float64)
    truth = []
    for q in range(0, n, n // 200):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        truth += [(q, r, int(i), scores[i]) for r, i in enumerate(np.argsort(-scores)[:20])]
    assert recall(found, truth) >= 0.9
