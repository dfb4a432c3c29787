"""A corpus pipeline over the given documents, made of the operators in ``tidemart.llm``.

Each stage takes the documents its predecessor kept and returns documents; the last returns them encoded.
Rows keep all columns. Stages are told apart by what they decide: reject, merge, redact, mix, encode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import jaccard, mixing, pieces, quality, secrets
from tidemart.llm.queries import CorpusQuery, graded
from tidemart.llm.tables import given, settled, ship


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose grade is probably the highest; those with an id the classifier rejects go.

    Rows without an id, and rows that share one, are kept if any row of that id is selected.
    """
    ship(spark)
    found = quality.assess(docs, graded(given(spark, sf_dir, "labels")))
    kept = found.where("selected").select("doc_id").distinct().alias("k")
    return docs.alias("d").join(kept, F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")), "left_semi")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more.

    The document with the smallest id stays; of rows that share that id, all whose text is in the group. Documents
    without words are in no group and stay.
    """
    ship(spark)
    found = jaccard.linked(docs.select(F.col("doc_id").alias("id"), "text"), words=5, num=80, den=100)
    kept = found.where(F.col("id").eqNullSafe(F.col("component_id"))).select(F.col("id").alias("doc_id")).distinct().alias("k")
    return docs.alias("d").join(kept, F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")), "left_semi")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with all reported secrets blotted out."""
    ship(spark)
    return secrets.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks: not at all, or up to three times."""
    ship(spark)
    taken = mixing.mix(docs).where("copies > 0").select("place", "source", "copies").distinct().alias("t")
    placed = docs.withColumn("__place", mixing.place(F.col("doc_id"), F.col("text"))).alias("d")
    same = (F.col("d.__place") == F.col("t.place")) & F.col("d.source").eqNullSafe(F.col("t.source"))
    each = F.explode(F.sequence(F.lit(1), F.col("t.copies"))).alias("__copy")
    return placed.join(taken, same).select("d.*", each).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, ids)``: what the mix holds, as piece ids."""
    ship(spark)
    return pieces.encode(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", one_of_each_group),
    ("secret scans", without_secrets),
    ("source mixing", mixed),
    ("SentencePiece encoding", encoded),
]

# Models and tokenizers are beyond SQL: the tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(ship(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": CorpusQuery(run, ORACLE_SQL)}
