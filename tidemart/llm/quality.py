"""A quality classifier: ordinal regression with cumulative links on hashed text features.

Ratings are grades 0, 1, ..., K - 1. One weight vector is shared by all grades; K - 1 ordered thresholds cut
the score: P(grade <= k) = sigmoid(threshold_k - score). The expected grade ranks texts, the tail
probability P(grade >= k) selects them.

The model is fitted in one task on at most ``SAMPLE`` labelled texts, chosen by a hash of their ids, and is
``2^BITS`` weights; scoring then runs over all texts in the tasks that read them, on whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm import textbytes

BITS = 18
# The fit's bound: so many labelled texts.
SAMPLE = 16_000
LEAST_TEXTS, LEAST_CONTRAST = 3, 1.5  # features of fewer sampled texts, or of no telling, have no weight
STEPS, RATE, DECAY = 150, 0.08, 1e-3
SELECT = 0.5

# Classes of bytes: white space, word (letters, digits, all beyond ASCII), other signs.
_CLASS = np.full(256, 2, np.uint8)
_CLASS[textbytes.SPACE] = 0
_CLASS[48:58] = _CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = 1
_SHAPES = 64  # the last slots hold features of a text's shape


def features(data: np.ndarray, offsets: np.ndarray, live: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs of a block of texts, by text.

    Features are the hashed tokens - words in lower case and runs of other signs - and the shape: how many tokens
    there are, and which shares are repeats, signs, capitals and distinct. ``live`` masks features to leave out.
    """
    n = len(offsets) - 1
    kinds = _CLASS[data]
    first = np.ones(len(data), bool)
    first[1:] = kinds[1:] != kinds[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    first[inner] = True
    starts = np.flatnonzero(first)
    ends = np.concatenate([starts[1:], [len(data)]]).astype(np.int64) if len(starts) else starts
    solid = kinds[starts] > 0
    starts, ends = starts[solid], ends[solid]
    text = np.searchsorted(offsets, starts, "right") - 1
    hashes = textbytes.span_hashes(textbytes.LOWER[data], starts, ends)
    slot = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    slot[slot >= (1 << BITS) - _SHAPES] -= _SHAPES

    count = np.bincount(text, minlength=n)
    some = np.maximum(count, 1)
    again = np.zeros(len(starts), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    capital = (data >= 65) & (data <= 90)
    capitals = np.concatenate([[0], np.cumsum(capital)])
    shares = [
        np.bincount(text, again, minlength=n) / some,
        np.bincount(text, kinds[starts] == 2, minlength=n) / some,
        (capitals[offsets[1:]] - capitals[offsets[:-1]]) / np.maximum(np.diff(offsets), 1),
    ]
    key = np.unique(text * (1 << BITS) + slot)
    shares.append(np.bincount(key >> BITS, minlength=n) / some)
    base = (1 << BITS) - _SHAPES
    shape = [base + np.minimum(np.log2(some), 15).astype(np.int64)]
    shape += [base + 16 + 12 * k + np.minimum(np.sqrt(s) * 12, 11).astype(np.int64) for k, s in enumerate(shares)]
    shape = np.stack(shape, axis=1)
    key = np.concatenate([key, (np.arange(n)[:, None] * (1 << BITS) + shape).ravel()])
    if live is not None:
        key = key[live[key & ((1 << BITS) - 1)]]
    key.sort()
    return key >> BITS, key & ((1 << BITS) - 1)


def _feature_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, data, offsets in textbytes.blocks(batch.column("text"), textbytes.SMALL_BLOCK_BYTES):
            n = len(offsets) - 1
            text, slot = features(data, offsets)
            at = np.searchsorted(text, np.arange(n + 1))
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(slot, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("grade").slice(row, n), lists], names=["grade", "slots"])


def fit(grades: np.ndarray, text: np.ndarray, slot: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights for all slots and the ordered thresholds, by full-batch gradient steps with adaptive rates."""
    n = len(grades)
    # Features enter in proportion to how differently the best grade's texts and the others have them.
    best = grades == levels - 1
    seen, good = np.bincount(slot, minlength=1 << BITS), np.bincount(slot[best[text]], minlength=1 << BITS)
    contrast = np.abs(np.log((good + 1) / (best.sum() + 2)) - np.log((seen - good + 1) / ((~best).sum() + 2)))
    keep = ((seen >= LEAST_TEXTS) & (contrast >= LEAST_CONTRAST))[slot]
    text, slot = text[keep], slot[keep]
    used, column = np.unique(slot, return_inverse=True)
    scale = contrast[used]
    share = np.cumsum(np.bincount(grades, minlength=levels) + 1.0) / (n + levels)
    cut = np.log(share[:-1] / (1 - share[:-1]))
    # The first threshold, and the logs of the gaps between them: they stay in order.
    values = np.concatenate([np.zeros(len(used)), cut[:1], np.log(np.maximum(np.diff(cut), 1e-3))])
    mean, square = np.zeros_like(values), np.zeros_like(values)
    logistic = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    for step in range(1, STEPS + 1):
        weights = values[: len(used)]
        gaps = np.exp(values[len(used) + 1 :])
        cuts = values[len(used)] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(text, (weights * scale)[column], minlength=n)
        below = logistic(cuts[None, :] - score[:, None])
        below = np.concatenate([np.zeros((n, 1)), below, np.ones((n, 1))], axis=1)
        slope = below * (1 - below)
        row = np.arange(n)
        p = np.maximum(below[row, grades + 1] - below[row, grades], 1e-9)
        upper, lower = slope[row, grades + 1] / p, slope[row, grades] / p
        by_score = (upper - lower) / n
        by_cut = np.zeros(levels + 1)
        np.add.at(by_cut, grades + 1, -upper / n)
        np.add.at(by_cut, grades, lower / n)
        by_cut = by_cut[1:-1]
        by_gap = gaps * (np.cumsum(by_cut[::-1])[::-1][1:])
        slopes = np.concatenate([np.bincount(column, by_score[text], minlength=len(used)) * scale + DECAY * weights, [by_cut.sum()], by_gap])
        mean = 0.9 * mean + 0.1 * slopes
        square = 0.99 * square + 0.01 * slopes**2
        values = values - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = values[: len(used)] * scale
    return weights, values[len(used)] + np.concatenate([[0.0], np.cumsum(np.exp(values[len(used) + 1 :]))])


def _fit_task(levels: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grades, slots, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for batch in batches:
            grades.append(batch.column("grade").to_numpy().astype(np.int64))
            slots.append(batch.column("slots").flatten().to_numpy())
            sizes.append(pa.compute.list_value_length(batch.column("slots")).to_numpy().astype(np.int64))
        grades, slots, sizes = map(np.concatenate, (grades, slots, sizes))
        if not len(grades):
            return
        weights, cuts = fit(grades, np.repeat(np.arange(len(grades), dtype=np.int32), sizes), slots, levels)
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()]), pa.array([cuts.tolist()])], names=["weights", "cuts"])

    return task


def _score_task(shared):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, cuts = shared.value
        live = weights != 0
        for batch in batches:
            scores = np.zeros(len(batch))
            for row, data, offsets in textbytes.blocks(batch.column("text"), textbytes.SMALL_BLOCK_BYTES):
                n = len(offsets) - 1
                text, slot = features(data, offsets, live)
                scores[row : row + n] = np.bincount(text, weights[slot], minlength=n)
            above = 1 / (1 + np.exp(-np.clip(scores[:, None] - cuts[None, :], -40, 40)))
            keep = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            tails = pa.FixedSizeListArray.from_arrays(pa.array(above.ravel()), len(cuts)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*keep, pa.array(above.sum(axis=1)), tails], names=[*names, "expected_grade", "tails"])

    return task


def train(rated: DataFrame, levels: int, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray] | None:
    """Weights and thresholds from ``rated (id, text, grade)``; None if no row has a text and a grade.

    At most ``sample`` rows are used, those of the lowest hashes. Grades outside 0 to ``levels - 1`` are left out.
    """
    rows = rated.where(F.col("text").isNotNull() & F.col("grade").between(0, levels - 1))
    model = rows.select(F.col("grade").cast("long").alias("grade"), F.col("text").cast("string").alias("text"))
    model = model.mapInArrow(_feature_task, "grade long, slots array<int>").limit(sample).repartition(1)
    row = model.mapInArrow(_fit_task(levels), "weights binary, cuts array<double>").first()
    return None if row is None else (np.frombuffer(row.weights, np.float32), np.array(row.cuts))


def sampled(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The labels of lowest hashes: the same rows on every run, however they are stored."""
    return labels.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample)


def grade(quality: Column, toxic: Column) -> Column:
    """The rating behind the given labels: 0 toxic, 1 poor, 2 good; null without a quality."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when(quality == 1, 2)


def assess(documents: DataFrame, labels: DataFrame, *, levels: int = 3, sample: int = SAMPLE, least: int | None = None) -> DataFrame:
    """``documents (doc_id, text)``'s ``(doc_id, expected_grade, tails, selected)``, a row for each of its rows.

    ``labels (doc_id, grade)``; ``tails[k]`` is P(grade >= k + 1), and ``selected`` where P(grade >= ``least``),
    by default the highest grade, is ``SELECT`` or more. A null text is scored as an empty one. Without any usable
    label every text has even odds and is selected. A document with several labels is used with each.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    labels = labels.where(F.col("doc_id").isNotNull() & F.col("grade").isNotNull()).select("doc_id", "grade")
    # The sample is bounded, so the texts need not be shuffled to meet it.
    model = train(rows.join(F.broadcast(sampled(labels, sample)), "doc_id"), levels, sample)
    if model is None:
        model = (np.zeros(1 << BITS, np.float32), np.zeros(levels - 1))
    scored = rows.mapInArrow(_score_task(spark.sparkContext.broadcast(model)), "doc_id long, expected_grade double, tails array<double>")
    best = (levels - 1 if least is None else least) - 1
    return scored.withColumn("selected", F.element_at("tails", best + 1) >= SELECT)
