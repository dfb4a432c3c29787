"""The corpus operators over whole tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import bitsliced, chat, jaccard, language, mixing, neighbours, pieces, quality, secrets, setsketch, spelling, suffixes, whitening
from tidemart.llm.tables import given, ship

NEIGHBOURS = 20
EVERY = 20  # searches ask for the rows whose id this divides


@dataclass(frozen=True)
class CorpusQuery:
    """``build`` makes the result; ``sql`` gives the same rows on the given tables."""

    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(ship(spark), folder)


def op1_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digests(secrets.scan(given(spark, folder, "documents")))


def op2_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(given(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


CONTROL = "\\### Assistant: </turn> ok"


def op3_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    rows = given(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    one = spark.createDataFrame([(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)], rows.schema)
    return chat.read_back(chat.formatted(rows.unionByName(one)))


def graded(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", quality.grade(F.col("quality"), F.col("toxic")).alias("grade"))


def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.assess(given(spark, folder, "documents"), graded(given(spark, folder, "labels")))
    tails = [F.element_at("tails", k).alias(f"p_grade_{k}_up") for k in (1, 2)]
    return found.select("doc_id", "expected_grade", *tails, "selected")


def _asked(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("id") % EVERY == 0)


def op5_projection_forest(spark: SparkSession, folder: str) -> DataFrame:
    rows = given(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    return neighbours.nearest(rows, _asked(rows), NEIGHBOURS)


def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.digests(pieces.decode(pieces.encode(given(spark, folder, "documents"))))


def op7_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    rows = given(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    return jaccard.linked(rows, words=3, num=90, den=100).withColumnRenamed("id", "doc_id")


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = given(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    return suffixes.without_repeats(rows).drop("kept").withColumnRenamed("id", "doc_id")


def op9_bit_sliced_topk(spark: SparkSession, folder: str) -> DataFrame:
    rows = given(spark, folder, "embeddings")
    rows = rows.select(F.col("vec_id").alias("id"), bitsliced.quantised(F.col("embedding")).alias("v"))
    return bitsliced.top(rows, _asked(rows), NEIGHBOURS)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    found = language.identify(given(spark, folder, "documents"), held_out(F.col("doc_id")))
    return found.select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "accepted")


def op11_setsketch_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = given(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    return setsketch.near_duplicates(rows, words=4, num=80, den=100).withColumnRenamed("id", "doc_id")


COMPONENTS = 8


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = given(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    return whitening.whitened(rows, COMPONENTS).withColumnRenamed("id", "vec_id")


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.grouped(given(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text"))


QUERIES: dict[str, CorpusQuery] = {
    "op1_secret_scans": CorpusQuery(op1_secret_scans),
    "op2_source_mixing": CorpusQuery(op2_source_mixing, mixing.MIX_SQL),
    "op3_chat_formatting": CorpusQuery(op3_chat_formatting),
    "op4_quality_classifier": CorpusQuery(op4_quality_classifier),
    "op5_projection_forest": CorpusQuery(op5_projection_forest),
    "op6_sentencepiece": CorpusQuery(op6_sentencepiece),
    "op7_ngram_jaccard_join": CorpusQuery(op7_ngram_jaccard_join),
    "op8_suffix_dedup": CorpusQuery(op8_suffix_dedup),
    "op9_bit_sliced_topk": CorpusQuery(op9_bit_sliced_topk, bitsliced.TOP_SQL),
    "op10_language_id": CorpusQuery(op10_language_id),
    "op11_setsketch_dedup": CorpusQuery(op11_setsketch_dedup),
    "op12_embedding_whitening": CorpusQuery(op12_embedding_whitening),
    "op13_spelling_variants": CorpusQuery(op13_spelling_variants),
}
