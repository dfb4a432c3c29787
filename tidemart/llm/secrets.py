"""Secret scans with linking of multipart credentials, in DataFrame operations only.

Three kinds of strong match are reported wherever they stand: assignments of named secrets, access
identifiers and long hexadecimal strings. Three kinds of weak candidate - plain identifiers, opaque keys and
endpoints - are far too common to report alone. They are interval-joined within scopes of ``SCOPE`` code
points, and one is reported only where its complementary parts stand: an identifier near a secret, a key
near an identifier, an endpoint near both.

Positions come from splitting a text at its matches: what lies between the matches, and the matches
themselves, give all offsets as running sums. Texts are read once and not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemart.llm.tables import settled

SCOPE = 200

# The strong kinds, in the order in which equal starts are listed. Access identifiers have 20
# characters or more and hexadecimal strings 24; as a run is always taken whole, the lengths may
# stand in the patterns. The value of an assignment has 6 or more, checked after matching.
STRONG = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
LEAST_VALUE = 6

WEAK = {
    # login = someone, client_id: abc123, or a short identifier with a known beginning
    "id": r"""(?i:access_?key_?id|client_?id|user_?name|login|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}|(?<![A-Z0-9])(?:AKIA|ASIA|AIDA|AROA)[A-Z0-9]{8,15}(?![A-Z0-9])""",
    # sixteen characters or more that mix capitals, small letters and digits
    "key": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[A-Z0-9+/_-]*[a-z])(?=[a-z0-9+/_-]*[A-Z])[A-Za-z0-9+/_-]{16,}={0,2}",
    "endpoint": r"""(?i:https?|s3|ftp|jdbc:[a-z]{2,16}|postgres|mysql|redis|mongodb)://[^\x00-\x20"'<>]+""",
}
KINDS = {name: rank for rank, name in enumerate([*STRONG, *WEAK])}
_IDS, _SECRETS = ["access", "id"], ["assign", "hex", "key"]
_STRONG_ENDS = len(STRONG)


def _measured(documents: DataFrame) -> DataFrame:
    """Per row and kind: lengths between matches and of the matches, and of the assigned values."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    patterns = STRONG | WEAK
    length = lambda x: F.length(x)
    found = rows.select(
        "doc_id", "text", F.sha2(F.col("text").cast("binary"), 256).alias("sha"),
        *[F.transform(F.split("text", p, -1), length).alias(f"gaps_{k}") for k, p in patterns.items()],
    )

    def lengths(kind: str, group: int) -> Column:
        return F.when(F.size(f"gaps_{kind}") > 1, F.transform(F.regexp_extract_all("text", F.lit(patterns[kind]), F.lit(group)), length))

    return found.select(
        "doc_id", "sha", *[F.when(F.size(f"gaps_{k}") > 1, F.col(f"gaps_{k}")).alias(f"gaps_{k}") for k in patterns],
        *[lengths(k, 0).alias(f"sizes_{k}") for k in patterns], lengths("assign", 2).alias("values_assign"),
    )


def _spans(measured: DataFrame) -> DataFrame:
    """``(doc_id, sha, kind, start, stop)`` of all matches and candidates; equal rows once."""
    each = []
    for kind, rank in KINDS.items():
        values = F.col("values_assign") if kind == "assign" else F.col(f"sizes_{kind}")
        # The piece after the last match has no match: its null is left out below.
        parts = F.arrays_zip(F.col(f"gaps_{kind}").alias("gap"), F.col(f"sizes_{kind}").alias("size"), values.alias("value"))
        rows = measured.where(F.col(f"sizes_{kind}").isNotNull()).select("doc_id", "sha", F.lit(rank).alias("kind"), F.posexplode(parts).alias("n", "part"))
        each.append(rows.select("doc_id", "sha", "kind", "n", "part.gap", "part.size", "part.value"))
    rows = each[0]
    for more in each[1:]:
        rows = rows.unionByName(more)
    rows = rows.distinct()
    so_far = Window.partitionBy("doc_id", "sha", "kind").orderBy("n")
    stop = F.sum(F.col("gap") + F.coalesce(F.col("size"), F.lit(0))).over(so_far)
    rows = rows.select("doc_id", "sha", "kind", (stop - F.col("size")).alias("start"), stop.alias("stop"), "size", "value")
    kept = (F.col("kind") != KINDS["assign"]) | (F.col("value") >= LEAST_VALUE)
    return rows.where(F.col("size").isNotNull() & kept).select("doc_id", "sha", "kind", "start", "stop")


def _near(left: DataFrame, right: DataFrame, within: int, how: str) -> DataFrame:
    """Rows of ``left`` with (or without) a row of ``right`` in the same text, at most ``within`` away.

    Both are dealt to stretches of ``SCOPE`` code points, so a task meets the parts of one stretch, not of a text.
    """
    def dealt(rows: DataFrame, reach: int) -> DataFrame:
        first, last = F.floor((F.col("start") - reach) / SCOPE), F.floor((F.col("stop") + reach) / SCOPE)
        return rows.withColumn("stretch", F.explode(F.sequence(first, last)))

    a, b = dealt(left, within).alias("a"), dealt(right, 0).alias("b")
    place = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.sha") == F.col("b.sha")) & (F.col("a.stretch") == F.col("b.stretch"))
    # At 0 away they overlap, further off they don't.
    apart = F.greatest(F.col("a.start") - F.col("b.stop"), F.col("b.start") - F.col("a.stop"))
    meets = (apart < 0) if within == 0 else (apart >= 0) & (apart <= within)
    met = a.join(b, place & meets, "left_semi").drop("stretch").distinct()
    if how == "with":
        return met
    same = F.col("a.doc_id").eqNullSafe(F.col("m.doc_id"))
    for c in ("sha", "kind", "start", "stop"):
        same = same & (F.col(f"a.{c}") == F.col(f"m.{c}"))
    return left.alias("a").join(met.alias("m"), same, "left_anti")


def _linked(spans: DataFrame) -> DataFrame:
    """The strong matches, and the weak candidates whose complementary parts are in scope."""
    strong = spans.where(F.col("kind") < _STRONG_ENDS)
    weak = settled(_near(spans.where(F.col("kind") >= _STRONG_ENDS), strong, 0, "without"), "weak-spans")
    parts = strong.unionByName(weak)
    ids = parts.where(F.col("kind").isin([KINDS[k] for k in _IDS]))
    secrets = parts.where(F.col("kind").isin([KINDS[k] for k in _SECRETS]))

    def of(kind: str) -> DataFrame:
        return weak.where(F.col("kind") == KINDS[kind])

    found = _near(of("id"), secrets, SCOPE, "with").unionByName(_near(of("key"), ids, SCOPE, "with"))
    return strong.unionByName(found).unionByName(_near(_near(of("endpoint"), ids, SCOPE, "with"), secrets, SCOPE, "with"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    texts = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string")))
    return F.array_join(texts, ",")


def scan(documents: DataFrame) -> DataFrame:
    """``(doc_id, sha, n_assign, n_access, n_hex, found)`` for every row of ``documents (doc_id, text)``.

    ``found`` lists ``(start, kind, stop)`` of all reported spans by start and kind, in code points, the end
    exclusive; ``kind`` is a number of ``KINDS``. ``sha`` names the text. A null text is empty and
    has no spans, nor has a row without a match; rows equal in id and text get the same result, rows with a
    null id are scanned as any other. Further columns are ignored.
    """
    measured = settled(_measured(documents), "measured")
    spans = settled(_spans(measured), "spans")
    per_text = _linked(spans).groupBy("doc_id", "sha").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "stop"))).alias("found"))
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.sha") == F.col("s.sha"))
    rows = measured.select("doc_id", "sha").alias("d").join(per_text.alias("s"), same, "left")
    nothing = F.array().cast("array<struct<start:bigint,kind:int,stop:bigint>>")
    rows = rows.select("d.doc_id", "d.sha", F.coalesce("s.found", nothing).alias("found"))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == KINDS[kind])).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in STRONG]
    return rows.select("doc_id", "sha", *counts, "found")


def digests(scanned: DataFrame) -> DataFrame:
    """The scan with its spans as text: ``base_sha256`` of the strong ones, ``spans`` with all."""
    base = F.filter("found", lambda s: s["kind"] < _STRONG_ENDS)
    return scanned.select(
        "doc_id", *[f"n_{k}" for k in STRONG], F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans")
    )


def redacted(documents: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every reported span replaced by ``mark``; ``n_chars`` follows the text if it is there.

    Overlapping spans are replaced as one. Rows without a span, and null texts, stay as they are.
    """
    hits = scan(documents.select("doc_id", "text")).where(F.size("found") > 0)
    hits = hits.select(F.col("doc_id").alias("of"), "sha", "found").groupBy("of", "sha").agg(F.any_value("found").alias("found"))
    own = F.sha2(F.col("text").cast("binary"), 256)
    rows = documents.withColumn("_own", own).alias("d")
    rows = rows.join(hits.alias("h"), F.col("d.doc_id").cast("long").eqNullSafe(F.col("h.of")) & (F.col("d._own") == F.col("h.sha")), "left")
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("done"))

    def cut(acc: Column, s: Column) -> Column:
        between = F.substring(F.col("d.text"), (acc["done"] + 1).cast("int"), F.greatest(s["start"] - acc["done"], F.lit(0)).cast("int"))
        new = F.when(s["start"] >= acc["done"], F.concat(acc["out"], between, F.lit(mark))).otherwise(acc["out"])
        return F.struct(new.alias("out"), F.greatest(acc["done"], s["stop"]).alias("done"))

    def rest(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(F.col("d.text"), (acc["done"] + 1).cast("int"), F.length("d.text")))

    text = F.when(F.col("h.found").isNull(), F.col("d.text")).otherwise(F.aggregate("h.found", start, cut, rest))
    out = rows.select(*[text.alias(c) if c == "text" else F.col(f"d.`{c}`") for c in documents.columns])
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return out
