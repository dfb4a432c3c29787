"""Jaccard join, pieces, quality and language on small inputs."""

import hashlib
import random
import re
import subprocess
import sys
import tracemalloc
import zlib
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemart.llm import jaccard, language, pieces, quality, textbytes
from tidemart.llm.components import components
from tidemart.llm.queries import QUERIES, held_out


def tiny():
    from tests.conftest import TINY

    return TINY


# --- n-gram Jaccard join ---


def linked(rows, words, num, den=100):
    """(id, size, component) by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} - {()})
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), doc if not sets[i] else min(group, default=None)))
    return sorted(out, key=repr)


def joined(frame, **options):
    return sorted((tuple(r) for r in jaccard.linked(frame, **options).collect()), key=repr)


@pytest.mark.parametrize(("words", "num"), [(3, 90), (5, 80), (1, 50)])
def test_join_matches_all_pairs(shipped, words, num):
    random.seed(num)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, n = [], 0
    for _ in range(25):
        base = random.choices(vocabulary, k=random.choice([2, 5, 30, 120]))
        for _ in range(random.choice([1, 1, 2, 6])):
            text = list(base)
            for _ in range(random.choice([0, 0, 1, 2, 4])):
                text[random.randrange(len(text))] = random.choice(vocabulary)
            rows.append((n * 37 % 1009, " ".join(text).upper() if random.random() < 0.2 else "\n".join(text)))
            n += 1
    frame = shipped.createDataFrame(rows, "id long, text string").repartition(4)
    assert joined(frame, words=words, num=num) == linked(rows, words, num)


def test_chain_of_near_copies(shipped):
    """A group whose ends are not similar: links must be found one by one."""
    words = [f"v{i}" for i in range(400)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 150])) for i in range(60)]
    frame = shipped.createDataFrame(rows, "id long, text string")
    assert joined(frame, words=3, num=90) == linked(rows, 3, 90)


def test_frequency_class_depends_on_the_words_alone():
    """Equal passages at both ends of a block of 2 MB, of few words that are all common."""
    random.seed(11)
    vocabulary = [f"w{i}" for i in range(200)]
    passage = random.choices(vocabulary, k=3_000)
    texts = [" ".join(t).encode() for t in (passage, random.choices(vocabulary, k=430_000), passage)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    assert 1_800_000 < len(data) <= textbytes.BLOCK_BYTES
    slots = np.zeros(jaccard.SLOTS)
    np.add.at(slots, jaccard._slot(jaccard.word_hashes(data, offsets)[0]), 1)
    common = (jaccard.word_levels(slots * 1_000), np.zeros(1 << (jaccard.FREQUENT_BITS - 6), np.uint64))
    (tokens, classes), _, (same, others) = jaccard.shingle_sets(data, offsets, 3, common)
    assert (tokens == same).all() and (classes == others).all()
    for order in range(jaccard.ORDERS):
        assert (jaccard.prefix(tokens, classes, order, 90, 100) == jaccard.prefix(same, others, order, 90, 100)).all()


def test_workers_need_little_room_for_texts():
    """A worker keeps the room of its largest step through all later stages: a batch of 6 MB is worked on in small blocks."""
    random.seed(5)
    rows = [" ".join(random.choices([f"w{i}" for i in range(3_000)], k=1_000)) for _ in range(1_100)]
    ids = pa.array(range(len(rows)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, pa.array(rows), pa.array([i % 3 for i in range(len(rows))], pa.int64())], names=["id", "text", "grade"])
    model = SimpleNamespace(value=(np.ones(1 << quality.BITS, np.float32), np.zeros(2)))
    for task in (quality._score_task(model), quality._feature_task, jaccard._class_task(5)):
        textbytes._POWERS.clear()
        tracemalloc.start()
        done = sum(1 for _ in task(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert done and peak < 40_000_000


@pytest.mark.parametrize("most", [1, 50, 10_000])
def test_blocks_cover_all_rows(most):
    texts = [None, "", "a" * 70, "b", None, "c" * 30, "d" * 49, ""]
    found = [bytes(data[a:b]) for _, data, ends in textbytes.blocks(pa.array(texts), most) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    assert found == [(t or "").encode() for t in texts]


def test_join_of_odd_rows(odd_documents):
    rows = odd_documents.select(F.col("doc_id").alias("id"), "text", "key", "token")
    assert joined(rows, words=3, num=90) == linked([(r.id, r.text) for r in rows.collect()], 3, 90)
    assert joined(rows.where("false"), words=3, num=90) == []


def test_join_of_given_documents(shipped):
    rows = shipped.read.parquet(f"{tiny()}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((tuple(r) for r in QUERIES["op7_ngram_jaccard_join"](shipped, tiny()).collect()), key=repr)
    assert got == linked([tuple(r) for r in rows], 3, 90)


def test_components(shipped):
    edges = [(i, i + 1) for i in range(40)] + [(100, 5), (200, 201), (201, 202), (202, 200), (300, 300), (400, 500), (400, 500)]
    got = {r.node: r.component for r in components(shipped.createDataFrame(edges, "a long, b long")).collect()}
    assert got == dict.fromkeys([*range(41), 100], 0) | dict.fromkeys([200, 201, 202], 200) | {400: 400, 500: 400}
    assert components(shipped.createDataFrame([], "a long, b long")).collect() == []


# --- pieces ---


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.vocabulary(pieces.MODEL)


def best_score(v, text):
    best = [0] + [None] * len(text)
    for j in range(1, len(text) + 1):
        options = [best[i] + v.pieces[text[i:j]][0] for i in range(max(0, j - v.longest), j) if text[i:j] in v.pieces]
        if text[j - 1] not in v.pieces:
            options.append(best[j - 1] + len(text[j - 1].encode()) * v.byte_score)
        best[j] = max(options)
    return best[-1]


def some_text(seed):
    random.seed(seed)
    parts = ["the quick", " ", "  ", "\n", "▁", "é", "中文", "aaaa", "😀", "\0", "internationalisation", " a", "!!!", "\t"]
    return "".join(random.choices(parts, k=random.randrange(30)))


@pytest.mark.parametrize("seed", range(40))
def test_best_cut_and_round_trip(vocabulary, seed):
    text = some_text(seed)
    ids = vocabulary.encode(text)
    assert vocabulary.score(ids) == best_score(vocabulary, text)
    assert vocabulary.decode(ids) == text


@pytest.mark.parametrize("seed", range(25))
@pytest.mark.parametrize("size", [1, 3, 17, 40])
def test_chunks_give_the_best_cut(vocabulary, seed, size):
    text = some_text(seed) + some_text(seed + 100).replace(" ", "") + "x"
    chunks = [(text[a : a + size + vocabulary.longest], min(size, len(text) - a)) for a in range(0, len(text), size)]
    states = pieces.scan([vocabulary.matrix(*c) for c in chunks])
    assert all(a[1] == b[0] for a, b in zip(states[:-1], states[1:], strict=True))
    ids = [i for c, s in zip(chunks, states, strict=True) for i in vocabulary.between(*c, *s)]
    assert vocabulary.decode(ids) == text
    assert vocabulary.score(ids) == best_score(vocabulary, text)


def test_product_is_associative():
    random = np.random.default_rng(1)
    a, b, c = (np.where(random.random((5, 5)) < 0.2, pieces.NEVER, random.integers(-99, 0, (5, 5))) for _ in range(3))
    assert (pieces.product(pieces.product(a, b), c) == pieces.product(a, pieces.product(b, c))).all()


def traced_chunks(many):
    """Traces one batch of so many chunks in a process of its own; the peak of its memory in MB, without what it began with."""
    script = f"""
import random, resource
import numpy as np, pyarrow as pa
from tidemart.llm import pieces
v = pieces.vocabulary(pieces.MODEL)
random.seed(1)
words = ["".join(random.choices("abcdefghijklmnop", k=random.randrange(1, 11))) for _ in range(60_000)]
text = " ".join(random.choices(words, k=pieces.CHUNK))[: pieces.CHUNK + v.longest]
v.encode("warm up")
texts = [text[k:] + text[:k] for k in random.sample(range(len(text)), {many})]
batch = pa.table({{"doc_id": [1] * {many}, "sha": ["s"] * {many}, "n": list(range({many})), "size": [pieces.CHUNK] * {many}, "text": texts, "enter": [0] * {many}, "leave": [0] * {many}}})
batch = batch.combine_chunks().to_batches()[0]
texts.clear()
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
rows = sum(len(b) for b in pieces._trace_task(pieces.MODEL)(iter([batch])))
assert rows == {many}
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024)
"""
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=600, cwd=Path(pieces.__file__).parents[2])
    assert done.returncode == 0, done.stderr[-2000:]
    return float(done.stdout.split()[-1])


def test_tracing_a_large_batch_takes_little_memory():
    """A thousand chunks of 32,768 characters, their outcome read as it comes: 250 MB at most."""
    assert traced_chunks(1000) < 250


def test_ids_are_those_of_a_brute_force_cut(shipped, vocabulary):
    """Best sums and, where only one cut has the best sum, the very ids."""
    rows = shipped.read.parquet(f"{tiny()}/documents.parquet").where("length(text) < 3000").limit(25).collect()
    found = {r.doc_id: r for r in QUERIES["op6_sentencepiece"](shipped, tiny()).collect()}
    for row in rows:
        text, best, ways, back = row.text, [0], [1], [None]
        for j in range(1, len(text) + 1):
            options = [(best[i] + vocabulary.pieces[text[i:j]][0], i, [vocabulary.pieces[text[i:j]][1]]) for i in range(max(0, j - vocabulary.longest), j) if text[i:j] in vocabulary.pieces]
            if text[j - 1] not in vocabulary.pieces:
                raw = text[j - 1].encode()
                options.append((best[j - 1] + len(raw) * vocabulary.byte_score, j - 1, [vocabulary.bytes[b] for b in raw]))
            top = max(o[0] for o in options)
            best.append(top)
            ways.append(sum(ways[i] for value, i, _ in options if value == top))
            back.append(min((i, ids) for value, i, ids in options if value == top))
        at, ids = len(text), []
        while at:
            at, own = back[at][0], back[at][1]
            ids = own + ids
        assert vocabulary.score(vocabulary.encode(text)) == best[-1]
        if ways[-1] == 1:
            assert found[row.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert found[row.doc_id].n_pieces == len(ids)


def test_encoding_of_odd_rows(odd_documents, no_documents):
    want = sorted(((r.doc_id, r.text) for r in odd_documents.collect()), key=repr)
    for chunk in (pieces.CHUNK, 50):
        out = pieces.decode(pieces.encode(odd_documents, chunk=chunk)).collect()
        assert sorted(((r.doc_id, r.text) for r in out), key=repr) == want
        assert all((r.ids is None) == (r.text is None) for r in out)
    assert pieces.encode(no_documents).collect() == []


def test_pieces_of_given_documents(shipped):
    got = {r.doc_id: (r.n_chars, r.text_sha256) for r in QUERIES["op6_sentencepiece"](shipped, tiny()).collect()}
    rows = shipped.read.parquet(f"{tiny()}/documents.parquet").collect()
    assert got == {r.doc_id: (len(r.text), hashlib.sha256(r.text.encode()).hexdigest()) for r in rows}


# --- quality classifier ---


def test_quality_on_labels_not_used_for_fitting(shipped):
    folder = "/root/testdata/sf0.1"
    labels = shipped.read.parquet(f"{folder}/labels.parquet")
    labels = labels.select("doc_id", quality.grade(F.col("quality"), F.col("toxic")).alias("grade"))
    docs = shipped.read.parquet(f"{folder}/documents.parquet")
    found = quality.assess(docs, labels.where("doc_id % 2 = 0"), sample=2000)
    held = found.join(labels.where("doc_id % 2 = 1"), "doc_id").toPandas()
    good = held.grade == 2
    assert held.selected[good].mean() > 0.97
    assert held.selected[~good].mean() < 0.1
    means = held.groupby("grade").expected_grade.mean()
    assert means[0] < means[2] and means[1] < means[2]


def test_thresholds_are_ordered_and_tails_fall(shipped):
    found = QUERIES["op4_quality_classifier"](shipped, tiny()).toPandas()
    assert (found.p_grade_1_up >= found.p_grade_2_up).all()
    assert np.allclose(found.expected_grade, found.p_grade_1_up + found.p_grade_2_up)


def test_ordinal_fit_by_differences():
    """The gradient steps reach a point where no small change lowers the loss much."""
    random = np.random.default_rng(0)
    grades = random.integers(0, 3, 200)
    text = np.repeat(np.arange(200), 2)
    slot = np.stack([grades * 10 + random.integers(0, 2, 200), 100 + random.integers(0, 5, 200)], 1).ravel()
    weights, cuts = quality.fit(grades, text, slot, 3)
    assert cuts[0] < cuts[1]
    score = np.bincount(text, weights[slot])
    assert (np.digitize(score, cuts) == grades).mean() > 0.95


def test_quality_of_odd_rows(odd_documents, no_documents, shipped):
    labels = shipped.createDataFrame([(8, 0), (10, 2), (50, 2), (None, 1), (3, None), (9, 7)], "doc_id long, grade int")
    out = quality.assess(odd_documents, labels).collect()
    assert len(out) == odd_documents.count()
    assert all(0 <= r.expected_grade <= 2 for r in out)
    assert quality.assess(no_documents, labels).collect() == []
    nothing = quality.assess(odd_documents, labels.where("false")).collect()
    assert all(r.selected and r.tails == [0.5, 0.5] for r in nothing)


# --- language identification ---


def test_language_of_held_out_documents(shipped):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op10_language_id"](shipped, folder).toPandas()
    rows = shipped.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").toPandas().merge(found, on="doc_id")
    assert all(rows.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in rows.doc_id])
    held = rows[rows.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert held.accepted.mean() > 0.95
    assert rows.score.between(0, 1).all()


def kneser_ney(texts):
    """log P(c | a b) by the formulas, from plain dictionaries."""
    from collections import Counter

    tri = Counter()
    for t in texts:
        stream = [1, *(ord(c.lower()) if c.isalpha() else 0 for c in t), 0]
        stream = [c for i, c in enumerate(stream) if not i or c or stream[i - 1]]
        tri.update(zip(stream, stream[1:], stream[2:], strict=False))
    bi, uni = Counter((b, c) for _, b, c in tri), Counter()
    for _, c in bi:
        uni[c] += 1

    def discount(counts):
        once, twice = (sum(v == k for v in counts.values()) for k in (1, 2))
        return once / (once + 2 * twice) if once else 0.5

    d1, d2, d3 = discount(uni), discount(bi), discount(tri)

    def p1(c):
        total = sum(uni.values())
        return (max(uni[c] - d1, 0) + d1 * len(uni) / language.ALPHABET) / total

    def p2(b, c):
        mine = [v for (x, _), v in bi.items() if x == b]
        return max(bi[b, c] - d2, 0) / sum(mine) + d2 * len(mine) / sum(mine) * p1(c)

    def p3(a, b, c):
        mine = [v for (x, y, _), v in tri.items() if (x, y) == (a, b)]
        return max(tri[a, b, c] - d3, 0) / sum(mine) + d3 * len(mine) / sum(mine) * p2(b, c)

    return {g: p3(*g) for g in tri}


def test_model_follows_the_formulas(shipped):
    texts = {"x": ["abra cadabra", "abba, baba!"], "y": ["zyzzyva", "Zebra zoo"]}
    frame = shipped.createDataFrame([(k, t) for k, ts in texts.items() for t in ts], "lang string, text string")
    rows = language.models(frame).where("n = 3").collect()
    mask = (1 << 21) - 1
    for lang, ts in texts.items():
        want = kneser_ney(ts)
        got = {(r.gram & mask, r.gram >> 21 & mask, r.gram >> 42): r.logp for r in rows if r.lang == lang}
        assert got.keys() == want.keys()
        assert all(abs(got[g] - np.log(want[g])) < 1e-9 for g in want)


def test_unseen_trigrams_never_read_as_seen(shipped):
    """Many different characters: trigrams that share 22 bits of a hash with a seen one are still unseen."""
    random.seed(3)
    signs = [chr(0x4E00 + i) for i in range(3_000)]
    rows = [("zh", "".join(random.choices(signs, k=2_000))) for _ in range(20)]
    arrays = language.GramArrays(language.models(shipped.createDataFrame(rows, "lang string, text string")))
    seen = arrays.keys[3]
    assert len(seen) > 35_000
    made = np.random.default_rng(3).integers(0x4E00, 0x4E00 + 3_000, (3, 20_000))
    unseen = np.setdiff1d(made[0] | (made[1] << 21) | (made[2] << 42), seen)
    hashes = [textbytes.mixed(x.astype(np.uint64)) >> np.uint64(42) for x in (seen, unseen)]
    assert np.isin(hashes[1], hashes[0]).sum() > 50
    assert (arrays.logp(unseen) == arrays._backed_off(unseen).astype(np.float32)).all()
    assert not np.isnan(arrays._found(3, seen, arrays.logs[3], np.nan)).any()


def test_language_of_odd_rows(odd_documents, no_documents):
    out = language.identify(odd_documents, held_out(F.col("doc_id"))).collect()
    assert len(out) == odd_documents.count()
    for r in out:
        assert r.lang_pred in ("en", "de", "und") and 0 <= r.score <= 1
    text = {(r.doc_id, r.text) for r in odd_documents.collect()}
    bare = {i for i, t in text if not any(c.isalpha() for c in t or "")} - {None}
    assert {r.doc_id for r in out if r.lang_pred == "und"} - {None} == bare
    assert language.identify(no_documents, held_out(F.col("doc_id"))).collect() == []
    unlearned = language.identify(odd_documents.withColumn("lang", F.lit(None).cast("string")), held_out(F.col("doc_id"))).collect()
    assert all(r.lang_pred == "und" and r.score == 0 for r in unlearned)
