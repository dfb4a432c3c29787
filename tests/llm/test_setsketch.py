"""SetSketch near-duplicates and the pivots they use, against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_texts import linked
from tidemart.llm import pivots, setsketch, sieve, textbytes
from tidemart.llm.components import components
from tidemart.llm.queries import QUERIES


def found(frame, **options):
    rows = setsketch.near_duplicates(frame, **options)
    assert rows.columns == ["id", "n_shingles", "component_id", "kept"]
    out = rows.collect()
    assert all(r.kept == (r.id == r.component_id) for r in out)
    return sorted(((r.id, r.n_shingles, r.component_id) for r in out), key=repr)


def families(seed, many, sizes=(1, 1, 2, 6), edits=(0, 0, 1, 2, 4, 9)):
    random.seed(seed)
    vocabulary, rows = [f"w{i}" for i in range(300)], []
    for _ in range(many):
        base = random.choices(vocabulary, k=random.choice([2, 5, 30, 120, 200]))
        for _ in range(random.choice(sizes)):
            text = list(base)
            for _ in range(random.choice(edits)):
                text[random.randrange(len(text))] = random.choice(vocabulary)
            rows.append((len(rows) * 37 % 1009, " ".join(text).upper() if random.random() < 0.2 else "\n".join(text)))
    return rows


@pytest.mark.parametrize(("words", "num"), [(4, 80), (3, 90)])
def test_same_as_all_pairs(shipped, words, num):
    rows = families(num, 30)
    frame = shipped.createDataFrame(rows, "id long, text string").repartition(4)
    assert found(frame, words=words, num=num) == linked(rows, words, num)


def test_large_groups_same_as_all_pairs(shipped):
    """Two families, many members of which lie just under the threshold of each other, and a chain."""
    rows = families(2, 3, sizes=(90,), edits=(0, 1, 2, 3, 4, 5, 6))
    words = [f"v{i}" for i in range(500)]
    rows += [(2000 + i, " ".join(words[4 * i : 4 * i + 150])) for i in range(60)]
    frame = shipped.createDataFrame(rows, "id long, text string").repartition(4)
    assert found(frame) == linked(rows, 4, 80)


def sets_frame(shipped, sets):
    return shipped.createDataFrame([(k, sorted(s)) for k, s in enumerate(sets)], "node long, tokens array<long>")


def by_pivots(shipped, sets, buckets, num, den, **options):
    """Components, and how many rows the joins made."""
    frame = sets_frame(shipped, sets)
    rows = [(b, k, len(sets[k]), len(sets[k]), 0, k) for b, members in enumerate(buckets) for k in members]
    held = shipped.createDataFrame(rows, ", ".join(f"{c} long" for c in pivots.HELD))
    sure, pairs = pivots.met(held, lambda nodes: frame.join(nodes, "node"), num, den, **options)
    for a, b in sure.collect():
        assert a < b and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])
    links = sure.unionByName(pivots.confirmed(pairs, frame, num, den))
    return {r.node: r.component for r in components(links).collect()}, sure.count() + pairs.count()


def by_all_pairs(sets, buckets, num, den):
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for members in buckets:
        for i in members:
            for j in members:
                if i < j and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                    up[max(root(i), root(j))] = min(root(i), root(j))
    return {k: root(k) for k in range(len(sets))}


@pytest.mark.parametrize(("seed", "num", "den", "by_size"), [(0, 90, 100, True), (1, 80, 100, False)])
def test_pivots_lose_nothing(shipped, monkeypatch, seed, num, den, by_size):
    monkeypatch.setattr(pivots, "FEW", 3)
    random.seed(seed)
    sets = []
    for _ in range(4):
        base = set(random.sample(range(400), random.choice([6, 30, 80])))
        for _ in range(25):
            some = set(base)
            for _ in range(random.choice([0, 1, 2, 3, 6])):
                some ^= {random.randrange(400)}
            if seed % 2 and random.random() < 0.5:  # a family within the family
                some ^= {1000, 1001, 1002, 1003, 1004, 1005}
            sets.append(some or {1})
    buckets = [range(len(sets)), random.sample(range(len(sets)), 40), [0, 1], [5]]
    got, _ = by_pivots(shipped, sets, buckets, num, den, by_size=by_size)
    want = by_all_pairs(sets, buckets, num, den)
    assert {k: got.get(k, k) for k in want} == want


@pytest.mark.parametrize(("words", "edits", "num"), [(3, 2, 90), (4, 3, 80)])
def test_members_just_under_the_threshold_make_few_rows(shipped, words, edits, num):
    """600 copies of a text with edits of their own, each two of them just not similar: no pairs by the square."""
    random.seed(9)
    sets = []
    for k in range(600):
        text = [f"w{i}" for i in range(120)]
        for at in random.sample(range(2, 118), edits):
            text[at] = f"x{k}-{at}"
        sets.append({hash(tuple(text[i : i + words])) for i in range(121 - words)})
    got, rows = by_pivots(shipped, sets, [range(600)], num, 100)
    want = by_all_pairs(sets, [range(600)], num, 100)
    assert {k: got.get(k, k) for k in want} == want
    assert rows < 20 * len(sets)


def test_a_pivot_that_is_unlike_the_others_makes_few_rows(shipped):
    """600 copies of a text with 1 to 6 edits of their own. The first pivot has many more edits: its differences are those of all members."""
    random.seed(11)
    sets = []
    for k in range(601):
        text = [f"w{i}" for i in range(120)]
        for at in random.sample(range(4, 116), 12 if k == 600 else 1 + k % 6):
            text[at] = f"x{k}-{at}"
        sets.append({hash(tuple(text[i : i + 4])) for i in range(117)})
    got, rows = by_pivots(shipped, sets, [range(601)], 80, 100)
    want = by_all_pairs(sets, [range(601)], 80, 100)
    assert {k: got.get(k, k) for k in want} == want
    assert rows < 5 * len(sets)


def test_differences_that_few_share_make_few_rows(shipped, monkeypatch):
    """240 members with 70 elements of their own each, and six families of 40 that share 60 of 100 differences."""
    made, settled = {}, pivots.settled

    def counted(rows, label):
        out = settled(rows, label)
        made.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(pivots, "settled", counted)
    base = set(range(420))
    own = lambda k, many: {1000 * (k + 1) + i for i in range(many)}
    sets = [base | own(k, 70) for k in range(240)]
    sets += [base | own(240 + k, 40) | own(1000 + k % 6, 60) for k in range(240)]
    got, rows = by_pivots(shipped, sets, [range(len(sets))], 80, 100)
    want = by_all_pairs(sets, [range(len(sets))], 80, 100)
    assert {k: got.get(k, k) for k in want} == want
    assert len(set(want.values())) == 246
    # Those of one member alone are not dealt, and the families are small enough to be compared without a pivot of their own.
    assert sum(made["dealt"]) < 20 * len(sets) and len(made["dealt"]) == 1
    assert rows <= 6 * 40 * 39 // 2


def test_each_difference_is_exploded_once(shipped, monkeypatch):
    """400 members with three elements of their own and two that half of them share: rows made by a round grow with the differences."""
    made, plans, settled = {}, [], pivots.settled

    def seen(rows, label):
        plans.append((label, rows._jdf.queryExecution().executedPlan().toString()))
        out = settled(rows, label)
        made.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(pivots, "settled", seen)
    sets = [set(range(50)) | {1000 + k % 2, 1002 + k % 2} | {10_000 + 3 * k + i for i in range(3)} for k in range(400)]
    got, _ = by_pivots(shipped, sets, [range(len(sets))], 95, 100)
    want = by_all_pairs(sets, [range(len(sets))], 95, 100)
    assert {k: got.get(k, k) for k in want} == want
    whole = [label for label, plan in plans for line in plan.splitlines() if "Generate explode(differ" in line and "least" in line]
    assert whole == ["each"] * len(made["dealt"])
    assert sum(made["each"]) <= 10 * len(sets)


def test_registers_merge_and_agree_as_often_as_sets_are_alike():
    rng = np.random.default_rng(4)
    x, y, z = (np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (40_000, 5_000, 5_000))
    a, b = np.union1d(x, y), np.union1d(x, z)
    ra, rb, rx, ry, union = setsketch.registers([a, b, x, y, np.union1d(a, b)])
    assert (setsketch.merged(rx, ry) == ra).all() and (setsketch.merged(ra, rb) == union).all()
    best, near = setsketch.estimate(ra[None], rb[None], np.array([45e3]), np.array([45e3]), 0.8)
    assert abs(best[0] - 0.8) < 0.12 and near[0]
    best, near = setsketch.estimate(rx[None], ry[None], np.array([40e3]), np.array([5e3]), 0.8)
    assert best[0] < 0.05 and not near[0]
    # Sizes can be read off the registers: a check of their spacing.
    for registers, size in ((rx, 40_000), (ry, 5_000)):
        assert abs((1 - 1 / setsketch.B) * setsketch.REGISTERS / (setsketch.A * np.log(setsketch.B) * (setsketch.B ** -registers.astype(float)).sum()) / size - 1) < 0.35


def test_sieve(shipped):
    marks = [5, -7, 2**62, -(2**63)]
    held = sieve.bitmap(shipped.createDataFrame([(m,) for m in marks], "mark long"))
    values = np.array([*marks, *range(10**15, 10**17, 10**13)], np.int64).view(np.uint64)
    assert sieve.passes(held, values)[:4].all() and sieve.passes(held, values)[4:].mean() < 0.5


def test_odd_rows(odd_documents):
    rows = odd_documents.select(F.col("doc_id").alias("id"), "text", "key", "token", "n", F.lit("x").alias("name"))
    assert found(rows) == linked([(r.id, r.text) for r in rows.collect()], 4, 80)
    assert found(rows.where("false")) == []


def test_texts_over_a_block(shipped):
    """Two near copies of over 2 MB, and one that shares half of them."""
    random.seed(6)
    base = random.choices([f"word{i}" for i in range(5_000)], k=textbytes.BLOCK_BYTES // 7)
    other = [w if random.random() > 0.01 else "changed" for w in base]
    half = base[: len(base) // 2] + random.choices([f"new{i}" for i in range(5_000)], k=len(base) // 2)
    rows = [(3, " ".join(base)), (1, " ".join(other)), (2, " ".join(half)), (4, "short")]
    assert len(rows[0][1]) > textbytes.BLOCK_BYTES
    got = found(shipped.createDataFrame(rows, "id long, text string"))
    assert {r[0]: r[2] for r in got} == {1: 1, 2: 2, 3: 1, 4: 4}


def test_given_documents(shipped):
    from tests.conftest import TINY

    rows = [tuple(r) for r in shipped.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text").collect()]
    result = QUERIES["op11_setsketch_dedup"](shipped, TINY)
    assert dict(result.dtypes) == {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"}
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in result.collect()) == sorted(linked(rows, 4, 80))
