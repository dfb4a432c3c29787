import hashlib
import random

import numpy as np
import pytest

from tidemart.llm import suffixes
from tidemart.llm.queries import QUERIES


def brute(rows):
    """Rows equal in id and text count once; nulls come first."""
    order = sorted({(r[0], r[1] or "") for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    # Texts that share an id are ordered by the engine's hash of them; not needed here.
    seen, kept = set(), {}
    for key in order:
        data = key[1].encode()
        hit = np.zeros(len(data), bool)
        for p in range(len(data) - 99):
            s = data[p : p + 100]
            if s in seen:
                hit[p : p + 100] = True
            seen.add(s)
        edges = np.diff(np.concatenate([[0], hit.astype(int)]))
        kept[key] = (len(data), int(hit.sum()), int((edges == 1).sum()), hashlib.sha256(np.frombuffer(data, np.uint8)[~hit].tobytes()).hexdigest())
    return sorted(((r[0], *kept[r[0], r[1] or ""]) for r in rows), key=repr)


def results(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def run(spark, rows):
    made = spark.createDataFrame(rows, "id long, text string").repartition(5)
    return results(suffixes.without_repeats(made).drop("kept"))


def corpus(seed, n=60):
    random.seed(seed)
    letters = ["ab", "abcdefgh", "é中a b"][seed % 3]
    passages = ["".join(random.choices(letters, k=random.choice([90, 100, 101, 150, 400]))) for _ in range(6)]
    out = []
    for i in range(n):
        parts = []
        for _ in range(random.randrange(6)):
            parts.append(random.choice(passages) if random.random() < 0.5 else "".join(random.choices(letters, k=random.randrange(200))))
        out.append((i * 7 % n, "".join(parts)))
    return out + [(n, out[3][1]), (n + 1, out[3][1]), (None, out[5][1])]


@pytest.mark.parametrize("seed", range(6))
def test_matches_brute_force(shipped, seed):
    rows = corpus(seed)
    assert run(shipped, rows) == brute(rows)


def test_periodic_and_short_texts(shipped):
    rows = [(1, "a" * 99), (2, "a" * 100), (3, "a" * 101), (4, "abc" * 200), (5, "xabc" * 60), (6, "bca" * 50), (7, None), (8, ""), (9, "é" * 80)]
    assert run(shipped, rows) == brute(rows)


def test_odd_rows(odd_documents, no_documents):
    rows = odd_documents.withColumnRenamed("id", "id_").withColumnRenamed("doc_id", "id")
    want = brute([(r.id, r.text) for r in rows.collect()])
    assert results(suffixes.without_repeats(rows).drop("kept")) == want
    assert results(suffixes.without_repeats(rows.where("false")).drop("kept")) == []


def test_given_documents(shipped):
    from tests.conftest import TINY

    rows = shipped.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text").collect()
    assert results(QUERIES["op8_suffix_dedup"](shipped, TINY)) == brute([tuple(r) for r in rows])


def test_kept_text_is_what_is_left(shipped):
    random.seed(8)
    text = "".join(random.choices("abcdefgh", k=150))
    made = shipped.createDataFrame([(1, text), (2, "é" + text + "!")], "id long, text string")
    kept = {r.id: bytes(r.kept).decode() for r in suffixes.without_repeats(made).collect()}
    assert kept == {1: text, 2: "é!"}


@pytest.mark.parametrize("seed", range(20))
def test_deep_shallow_sort(seed):
    random.seed(seed)
    n = random.randrange(1, 200)
    shared = bytes(random.choices(b"ab", k=96))
    rows = []
    for _ in range(n):
        k = random.choice([0, 8, 39, 40, 41, 70, 95, 96])
        tail = bytes(random.choices(b"abc", k=random.randrange(0, 97 - k)))
        rows.append((shared[:k] + tail).ljust(96, b"\0"))
    group = np.array([random.randrange(4) for _ in range(n)])
    matrix = np.frombuffer(b"".join(rows), np.uint8).reshape(n, 96)
    order, common = suffixes.deep_shallow_sort(matrix, group)
    assert [(group[i], rows[i]) for i in order] == sorted(zip(group, rows, strict=True))
    for place in range(1, n):
        a, b = order[place - 1], order[place]
        if group[a] != group[b]:
            assert common[place] == -1
        else:
            pairs = zip(rows[a], rows[b], strict=True)
            assert common[place] == next((i for i, (x, y) in enumerate(pairs) if x != y), 96)


def test_blind_trie():
    random.seed(1)
    for _ in range(50):
        strings = list({bytes(random.choices(b"ab", k=12)) for _ in range(random.randrange(1, 40))})
        assert [strings[i] for i in suffixes.blind_trie_order(strings)] == sorted(strings)


def test_every_window_has_its_anchor():
    random.seed(2)
    texts = ["".join(random.choices("abc ", k=random.choice([0, 50, 99, 100, 101, 700]))).encode() for _ in range(30)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    text, position, _, low, high = suffixes.anchors(np.frombuffer(b"".join(texts), np.uint8), offsets)
    covered = {(t, p - d) for t, p, a, b in zip(text, position, low, high, strict=True) for d in range(a, b + 1)}
    assert covered == {(i, s) for i, t in enumerate(texts) for s in range(len(t) - 99)}


@pytest.mark.parametrize("seed", range(3))
def test_windows_of_crowded_grams(shipped, monkeypatch, seed):
    """Grams of more than a few places meet window by window, with the same results."""
    monkeypatch.setattr(suffixes, "CROWDED", 3)
    rows = corpus(seed)
    assert run(shipped, rows) == brute(rows)


def test_a_common_passage_does_not_gather_its_surroundings(shipped, monkeypatch):
    """One passage between texts that all differ: only equal windows meet, not all contexts of a gram."""
    monkeypatch.setattr(suffixes, "CROWDED", 20)
    random.seed(4)
    passage = "".join(random.choices("abcdefgh", k=300))
    rows = [(i, "".join(random.choices("abcdefgh", k=120)) + passage + "".join(random.choices("abcdefgh", k=120))) for i in range(200)]
    made = shipped.createDataFrame(rows, "id long, text string").repartition(2)
    crowded = suffixes.crowded_slots(made)
    contexts = suffixes.contexts_of(made.selectExpr("id key", "id", "text"), crowded).where("ctx is not null")
    counts = [r["count"] for r in contexts.groupBy("h").count().collect()]
    assert crowded.any() and max(counts) <= 20
    whole = suffixes.contexts_of(made.selectExpr("id key", "id", "text"), np.zeros_like(crowded)).where("ctx is not null")
    assert max(r["count"] for r in whole.groupBy("h").count().collect()) > 100
    assert results(suffixes.without_repeats(made).drop("kept")) == brute(rows)
