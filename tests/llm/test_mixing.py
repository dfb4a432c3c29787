import hashlib
import re
from collections import defaultdict

import pytest

from tidemart.llm import mixing


def brute(rows):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows]
    total = defaultdict(int)
    for r, s in zip(rows, size, strict=True):
        total[r.source] += s
    names = sorted(total, key=lambda x: (x is None, (x or "").encode("utf-32-be")))
    weight = {x: [5, 2, 1][i % 3] for i, x in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(size))
    while open_:
        share = left / sum(weight[x] for x in open_)
        over = {x for x in open_ if weight[x] * share > 3 * total[x]}
        for x in over or open_:
            target[x] = 3.0 * total[x] if over else weight[x] * share
            left -= target[x] if over else 0
        open_ = open_ - over if over else set()
    place = lambda r: int(hashlib.md5(f"{'' if r.doc_id is None else r.doc_id}:{r.text or ''}".encode()).hexdigest()[:15], 16)
    taken = [0] * len(rows)
    for x in names:
        mine = [i for i, r in enumerate(rows) if r.source == x]
        whole = min(int(target[x] // total[x]), 3) if total[x] else 0
        left, done = target[x] - whole * total[x], 0
        places = sorted({place(rows[i]) for i in mine if size[i]})
        take = set()
        for p in places:
            words = sum(size[i] for i in mine if place(rows[i]) == p)
            if done + words <= left:
                take.add(p)
                done += words
            else:
                if done < left and done + words - left < left - done:
                    take.add(p)
                break
        for i in mine:
            taken[i] = min(size[i] * (whole + (place(rows[i]) in take)), 3 * size[i])
    return sorted(((r.doc_id, s, total[r.source], round(target[r.source], 6), t) for r, s, t in zip(rows, size, taken, strict=True)), key=repr)


def results(rows):
    out = mixing.mix(rows).collect()
    return sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.size * r.copies) for r in out), key=repr)


def test_matches_brute_force(shipped):
    from tests.conftest import TINY

    rows = shipped.read.parquet(f"{TINY}/documents.parquet")
    assert results(rows) == brute(rows.collect())


def test_odd_rows(odd_documents, no_documents):
    assert results(odd_documents) == brute(odd_documents.collect())
    assert results(no_documents) == []


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 1000, "c": 1, "d": 1}, {"a": 5, None: 5}, {"x": 0, "y": 7}, {"solo": 9}])
def test_targets_share_everything(shipped, sizes):
    rows = shipped.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))
    assert all(got[k] <= 3 * v + 1e-9 for k, v in sizes.items())


def test_taken_words_come_near_the_target(shipped):
    rows = shipped.range(5000).selectExpr("id as doc_id", "concat_ws(' ', transform(sequence(0, id % 40), x -> 'w')) as text", "if(id % 3 = 0, 'hot', concat('s', id % 7)) as source")
    out = mixing.mix(rows).selectExpr("source", "size * copies as taken", "target", "size").groupBy("source").agg({"taken": "sum", "target": "max", "size": "max"}).collect()
    for r in out:
        assert abs(r["sum(taken)"] - r["max(target)"]) <= r["max(size)"] / 2 + 1e-6
