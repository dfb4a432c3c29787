"""Language identification with interpolated Kneser-Ney character models, one for each language.

Texts become streams of lower-case letters, with one mark for any run of other characters and one for the
text's start. Trigrams are counted over all training texts in the tasks that read them; the models are built
from the counts with joins and windows. For scoring, each order's probabilities are kept as a sorted
array of the packed characters with a column of log probabilities for each language. The arrays go to every
task; they grow with the different trigrams of the training texts. A text gets the language of lowest cross-entropy
a character; it is *accepted* where that entropy is no higher than nearly all training texts of
that language have (``ACCEPTED`` of them), which is the calibrated rejection.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemart.llm import textbytes
from tidemart.llm.tables import settled

UNKNOWN = "und"
ACCEPTED = 0.995
# Alphabet size behind the unigrams: what a never seen character shares.
ALPHABET = 65536
# So many letters' evidence count towards the score at most.
EVIDENCE = 60
_GAP, _START = 0, 1
_COUNTS = "lang string, gram long, n long"
_SCORED = "doc_id long, lang string, held_out boolean, lang_pred string, cross_entropy double, score double"


@lru_cache(1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: is it a letter, and its lower case (the gap for all but letters)."""
    points = [chr(i) for i in range(0x110000)]
    letter = np.fromiter((c.isalpha() for c in points), bool, len(points))
    lower = np.zeros(len(points), np.int64)
    for i in np.flatnonzero(letter):
        low = points[i].lower()
        lower[i] = ord(low) if len(low) == 1 else i
    return letter, lower


def streams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The trigrams of a block of texts, packed; the text each belongs to; and which texts have letters."""
    n = len(offsets) - 1
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le", "surrogatepass"), np.uint32)
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    letter, lower = _letters()
    text = np.repeat(np.arange(n), np.diff(before))
    codes = np.zeros(len(points) + 2 * n, np.int64)  # each text ends in a gap
    owner = np.repeat(np.arange(n), np.diff(before) + 2)
    codes[np.arange(len(points)) + 2 * text + 1] = lower[points]
    codes[before[:-1] + 2 * np.arange(n)] = _START
    has = np.bincount(text[letter[points]], minlength=n) > 0
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != _GAP) | (codes[:-1] != _GAP)
    codes, owner = codes[keep], owner[keep]
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    own = (b != _START) & (c != _START)
    return (a | (b << 21) | (c << 42))[own], owner[2:][own], has


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(parts):
        grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        return grams, np.bincount(where, np.concatenate([n for _, n in parts])).astype(np.int64)

    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        for row, data, offsets in textbytes.blocks(batch.column("text")):
            grams, owner, _ = streams(data, offsets)
            mine = langs[row : row + len(offsets) - 1]
            for lang in set(mine):
                parts = held.setdefault(lang, [])
                parts.append(np.unique(grams[(mine == lang)[owner]], return_counts=True))
                if len(parts) > 20:
                    held[lang] = [merged(parts)]
    for lang, parts in held.items():
        grams, n = merged(parts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.int64()), pa.array(n, pa.int64())], names=["lang", "gram", "n"])


def _by_language(rows: DataFrame) -> DataFrame:
    """A row a language: its rows, their counts' sum, and Kneser-Ney's discount from what was seen once and twice.

    A written table, so that Spark knows its size and can send it to the rows instead of gathering a language's rows.
    """
    once, twice = (F.sum(F.when(F.col("n") == k, 1).otherwise(0)) for k in (1, 2))
    discount = F.when(once > 0, once / (once + 2 * twice)).otherwise(F.lit(0.5)).cast("double")
    return settled(rows.groupBy("lang").agg(discount.alias("d"), F.sum("n").alias("total"), F.count("*").alias("types")), "discounts")


def models(training: DataFrame) -> DataFrame:
    """``(lang, n, gram, logp, log_rest)`` for the three orders of every language of ``training (lang, text)``.

    ``gram`` packs the characters, the predicted one highest. A row's ``log_rest`` is the share that its gram, as a
    context, leaves to the next lower order; 0 for trigrams, which are no contexts.
    """
    counts = training.mapInArrow(_count_task, _COUNTS).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    mask = (1 << 21) - 1
    part = lambda k: F.shiftright("gram", 21 * k).bitwiseAND(F.lit(mask))
    tri = settled(counts.select("lang", part(0).alias("a"), part(1).alias("b"), part(2).alias("c"), "n"), "trigrams")

    def with_context(rows: DataFrame, *context: str) -> DataFrame:
        whole = _by_language(rows)
        if not context:
            return rows.join(whole, "lang")
        by = Window.partitionBy("lang", *context)
        rows = rows.join(whole.select("lang", "d"), "lang")
        return rows.withColumn("total", F.sum("n").over(by)).withColumn("types", F.count("*").over(by))

    # Lower orders count in how many contexts a character follows, not how often.
    bi = tri.groupBy("lang", "b", "c").agg(F.count("*").alias("n"))
    uni = with_context(bi.groupBy("lang", "c").agg(F.count("*").alias("n")))
    uni = uni.select("lang", "c", ((F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) + F.col("d") * F.col("types") / ALPHABET) / F.col("total")).alias("p"))

    def interpolated(rows: DataFrame, lower: DataFrame, on: list[str]) -> DataFrame:
        rows = rows.join(lower.withColumnRenamed("p", "p_lower"), on)
        rest = F.col("d") * F.col("types") / F.col("total")
        p = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total") + rest * F.col("p_lower")
        return rows.withColumn("p", p).withColumn("rest", rest)

    bi = settled(interpolated(with_context(bi, "b"), uni, ["lang", "c"]), "bigrams")
    tri = settled(interpolated(with_context(tri, "a", "b"), bi.select("lang", "b", "c", "p"), ["lang", "b", "c"]), "models")
    pack = lambda *cs: sum((F.shiftleft(F.col(c), 21 * k) for k, c in enumerate(cs)), F.lit(0).cast("long"))
    rest2 = bi.groupBy("lang", F.col("b").alias("c")).agg(F.max("rest").alias("rest"))
    rest3 = tri.groupBy("lang", F.col("a").alias("b"), F.col("b").alias("c")).agg(F.max("rest").alias("rest"))
    none = F.lit(1.0)
    rows = uni.join(rest2, ["lang", "c"], "full").select("lang", F.lit(1).alias("n"), pack("c").alias("gram"), "p", F.coalesce("rest", none).alias("rest"))
    rows = rows.unionByName(
        bi.select("lang", "b", "c", "p").join(rest3, ["lang", "b", "c"], "full").select("lang", F.lit(2).alias("n"), pack("b", "c").alias("gram"), "p", F.coalesce("rest", none).alias("rest"))
    ).unionByName(tri.select("lang", F.lit(3).alias("n"), pack("a", "b", "c").alias("gram"), "p", none.alias("rest")))
    return rows.select("lang", "n", "gram", F.log("p").alias("logp"), F.log(F.greatest("rest", F.lit(1e-9))).alias("log_rest"))


class GramArrays:
    """The models of all languages: for each order a sorted array of grams, and a row of logs for each."""

    def __init__(self, rows: DataFrame):
        # A row for each language and gram reaches the driver, and then the tasks.
        table = rows.select("lang", "n", "gram", F.col("logp").cast("float"), F.col("log_rest").cast("float")).toArrow()
        lang = table.column("lang").combine_chunks().dictionary_encode()
        names = lang.dictionary.to_pylist()
        self.langs = sorted(names)
        number = np.array([self.langs.index(x) for x in names], np.int64)[lang.indices.to_numpy()]
        order, grams = table.column("n").to_numpy(), table.column("gram").to_numpy()
        logp, rest = table.column("logp").to_numpy(zero_copy_only=False), table.column("log_rest").to_numpy()
        self.keys, self.logs, self.rests = {}, {}, {}
        for n in (1, 2, 3):
            mine = order == n
            self.keys[n] = np.unique(grams[mine])
            at = np.searchsorted(self.keys[n], grams[mine])
            self.logs[n] = np.full((len(self.keys[n]), len(self.langs)), np.nan, np.float32)
            self.logs[n][at, number[mine]] = logp[mine]
            self.rests[n] = np.zeros((len(self.keys[n]), len(self.langs)), np.float32)
            self.rests[n][at, number[mine]] = rest[mine]

    def _found(self, n: int, grams: np.ndarray, values: np.ndarray, missing: float) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys[n], grams), len(self.keys[n]) - 1)
        out = values[at]
        out[self.keys[n][at] != grams] = missing
        return out

    def logp(self, grams: np.ndarray) -> np.ndarray:
        """Log probability of each trigram's last character, under each language."""
        out = self._found(3, grams, self.logs[3], np.nan)
        miss = np.flatnonzero(np.isnan(out).any(axis=1))
        if len(miss):
            out[miss] = np.where(np.isnan(out[miss]), self._backed_off(grams[miss]), out[miss])
        return out

    def _backed_off(self, grams: np.ndarray) -> np.ndarray:
        mask = (1 << 21) - 1
        a, b, c = grams & mask, (grams >> 21) & mask, grams >> 42
        one = self._found(1, c, self.logs[1], np.nan)
        one = np.where(np.isnan(one), -np.log(ALPHABET) - 2.0, one)
        two = self._found(2, b | (c << 21), self.logs[2], np.nan)
        two = np.where(np.isnan(two), self._found(1, b, self.rests[1], 0.0) + one, two)
        return self._found(2, a | (b << 21), self.rests[2], 0.0) + two


def _score_task(shared):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        k = len(model.langs)
        for batch in batches:
            valid = batch.column("text").is_valid().to_numpy(zero_copy_only=False)
            for row, data, offsets in textbytes.blocks(batch.column("text")):
                n = len(offsets) - 1
                grams, owner, has = streams(data, offsets)
                known = has & valid[row : row + n] & (k > 0)
                total = np.zeros((n, max(k, 1)))
                count = np.maximum(np.bincount(owner, minlength=n), 1)
                if k and len(grams):
                    # Equal trigrams of a block are looked up once.
                    grams, back = np.unique(grams, return_inverse=True)
                    logs = model.logp(grams)
                    for j in range(k):
                        total[:, j] = np.bincount(owner, logs[back, j], minlength=n)
                entropy = -total / count[:, None]
                best = entropy.argmin(axis=1)
                low = entropy[np.arange(n), best]
                odds = np.exp((low[:, None] - entropy) * np.minimum(count, EVIDENCE)[:, None]).sum(axis=1)
                langs = [model.langs[j] if ok else UNKNOWN for j, ok in zip(best, known, strict=True)]
                rest = [batch.column(c).slice(row, n) for c in ("doc_id", "lang", "held_out")]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(langs, pa.string()), pa.array(np.where(known, low, np.nan), pa.float64(), mask=~known), pa.array(np.where(known, 1 / odds, 0.0))],
                    names=["doc_id", "lang", "held_out", "lang_pred", "cross_entropy", "score"],
                )

    return task


def identify(documents: DataFrame, held_out: Column) -> DataFrame:
    """``(doc_id, lang, held_out, lang_pred, score, cross_entropy, accepted)`` for every row of ``documents (doc_id, text, lang)``.

    Models are learned from all rows that are not held out (a null there counts as held out, but is returned as
    false) and have both a text and a language. ``lang_pred`` is ``und`` for a text that is null or has no
    letter, with score 0, no entropy and not accepted; so is every text if nothing could be learned. Equal texts
    get equal results; ties go to the language first by name. Further columns are ignored.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), held_out.alias("out")
    )
    training = rows.where(~F.coalesce("out", F.lit(True)) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    shared = documents.sparkSession.sparkContext.broadcast(GramArrays(models(training)))
    asked = rows.select("doc_id", "lang", F.coalesce("out", F.lit(False)).alias("held_out"), "text")
    scored = settled(asked.mapInArrow(_score_task(shared), _SCORED), "scored")
    own = scored.where(~F.col("held_out") & (F.col("lang") == F.col("lang_pred")))
    limits = own.groupBy("lang_pred").agg(F.percentile_approx("cross_entropy", F.lit(ACCEPTED), F.lit(1000)).alias("limit"))
    # A row a language, written: Spark knows its size, and need not gather the texts of a language.
    out = scored.join(settled(limits, "limits"), "lang_pred", "left")
    accepted = F.coalesce(F.col("cross_entropy") <= F.col("limit"), F.lit(False))
    return out.select("doc_id", "lang", "held_out", "lang_pred", "score", "cross_entropy", accepted.alias("accepted"))
