"""Mixing sources to target weights with hash thresholds, without sorting documents.

Every document has a place in [0, 2^60), a hash of its id and text. A source's target is met by whole
copies of the source and one further copy of the documents placed below a threshold. The threshold comes
from histograms: words are summed by source and leading bits of the place, the bucket in which the running
sum passes what is left to take is found, and only that bucket is summed again by its next bits. After four
rounds of 15 bits the bucket is one place. A histogram has at most 32,768 rows a source, whatever the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemart.llm.tables import settled

WEIGHTS = (5, 2, 1)
LARGEST_REPEAT = 3
BITS, ROUNDS = 15, 4


def word_count(text: Column) -> Column:
    r"""Runs of characters other than \x20 and \x09 to \x0D; null text has none."""
    # Java's \s is [ \t\n\x0B\f\r], these six characters.
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def place(doc_id: Column, text: Column) -> Column:
    """60 bits of a digest, the same on any engine."""
    own = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(own.cast("binary")), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = LARGEST_REPEAT) -> DataFrame:
    """``(source, source_size, target)``: the whole size shared by weight, none above ``most`` times its own.

    Sources are few rows; they are ranked in one task. With caps in order of cap by weight, a source is
    capped when its cap is below its share of what the sources before it leave over.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = total.withColumn("weight", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size").cast("double") * most)
    line = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    onwards = line.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = F.sum("source_size").over(Window.partitionBy())
    ranked = ranked.withColumn(
        "share", (everything - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onwards)
    )
    ranked = ranked.withColumn("capped", F.col("cap") < F.col("weight") * F.col("share"))
    level = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "share"))).over(Window.partitionBy())
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * level["share"])
    return ranked.select("source", "source_size", target.alias("target"))


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = LARGEST_REPEAT) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, place)`` for every row of ``documents (doc_id, text, source)``.

    ``copies`` says how often the document is taken, 0 to ``most`` times. A source's taken words differ
    from its target by at most half the words at its boundary place: that is one document, or all rows
    equal in id and text, which are taken together. A null text, and one of white space only, has size 0 and
    no influence; a null source is a source. Further columns are ignored.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source")
    )
    sizes = settled(
        rows.select("doc_id", "source", word_count(F.col("text")).alias("size"), place(F.col("doc_id"), F.col("text")).alias("place")),
        "sizes",
    )
    goal = targets(sizes, weights, most)
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0)
    goal = goal.withColumn("whole", whole.cast("int")).withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
    goal = settled(goal.withColumn("low", F.lit(0).cast("long")).withColumn("below", F.lit(0).cast("long")), "goals")

    same = F.col("d.source").eqNullSafe(F.col("g.source"))
    for k in range(ROUNDS):
        shift = BITS * (ROUNDS - 1 - k)
        # The documents of each source's boundary bucket: all of them, at first.
        inside = (F.shiftright("d.place", shift + BITS) == F.shiftright("g.low", shift + BITS)) & (F.col("d.size") > 0)
        bucket = F.shiftleft(F.shiftright("d.place", shift), shift)
        sums = sizes.alias("d").join(goal.alias("g"), same & inside)
        sums = sums.groupBy(F.col("g.source").alias("source"), bucket.alias("bucket")).agg(F.sum("d.size").alias("words"))
        up_to = Window.partitionBy("source").orderBy("bucket")
        sums = sums.withColumn("until", F.sum("words").over(up_to)).alias("d").join(goal.alias("g"), same)
        # The last bucket that starts at or below what is left to take.
        start = F.col("g.below") + F.col("d.until") - F.col("d.words")
        bounds = sums.where(start <= F.col("g.left")).groupBy(F.col("g.source").alias("source"))
        bounds = bounds.agg(F.max(F.struct(F.col("d.bucket").alias("low"), start.alias("below"), F.col("d.words").alias("words"))).alias("b"))
        goal = goal.alias("g").join(bounds.alias("d"), same, "left").select(
            *[f"g.{c}" for c in ("source", "source_size", "target", "whole", "left")],
            F.coalesce("d.b.low", "g.low").alias("low"), F.coalesce("d.b.below", "g.below").alias("below"), F.coalesce("d.b.words", F.lit(0)).alias("words"),
        )
        goal = settled(goal, "goals")
    # The boundary place itself is taken if that comes nearer to the target.
    nearer = F.col("below") + F.col("words") - F.col("left") < F.col("left") - F.col("below")
    goal = goal.withColumn("low", F.col("low") + F.when(nearer, 1).otherwise(0))
    out = sizes.alias("d").join(goal.alias("g"), same)
    copies = F.col("g.whole") + F.when(F.col("d.place") < F.col("g.low"), 1).otherwise(0)
    return out.select("d.doc_id", "d.source", "d.size", "g.source_size", "g.target", F.least(copies, F.lit(most)).cast("int").alias("copies"), "d.place")


MIX_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS place
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
ranked AS (
  SELECT *, CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight,
         3.0::DOUBLE * source_size AS cap FROM totals),
shares AS (
  SELECT *, ((SELECT sum(source_size) FROM totals) - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM ranked),
goals AS (
  SELECT source, source_size, CASE WHEN cap < weight * share THEN cap
         ELSE weight * (SELECT arg_min(share, cap / weight) FROM shares WHERE cap >= weight * share) END AS target FROM shares),
parts AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END AS whole FROM goals),
sums AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place) AS until,
         sum(s.size) OVER (PARTITION BY s.source, s.place) AS tied
  FROM sizes s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(size * least(whole + CASE WHEN until <= rest OR (until - tied < rest AND until - rest < rest - (until - tied))
       THEN 1 ELSE 0 END, 3) AS BIGINT) AS taken
FROM sums"""
