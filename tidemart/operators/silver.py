"""Raw events -> five typed, quality-filtered tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.schemas import INT, MONEY, SILVER_EVENT, TEXT, payload_schema, silver_schema


def quality_rule(table: str) -> Column:
    """What a row must have to enter the table; a condition that is NULL rejects the row."""
    has_user = F.col("user_id").isNotNull()
    return {
        "page_views": has_user,
        "purchases": has_user & F.col("total_amount").isNotNull(),
        "cart_events": has_user & (F.col("quantity") > 0),
        "user_sessions": has_user,
        "product_updates": F.col("product_id").isNotNull(),
    }[table]


# The fields the rules look at.
_RULE_FIELDS = T.StructType(
    [
        T.StructField("user_id", TEXT),
        T.StructField("product_id", TEXT),
        T.StructField("total_amount", MONEY),
        T.StructField("quantity", INT),
    ]
)


def to_silver(bronze: DataFrame, table: str, *, now: Column | None = None) -> DataFrame:
    """One silver table from raw events: route by type, parse, keep rows that pass.

    ``inline`` instead of plain struct access: filters cannot move below a generator, so each
    message is parsed once. With struct access the rule is pushed under the projection and
    the message is parsed a second time inside the filter.
    """
    event_type = SILVER_EVENT[table]
    parsed = F.from_json("raw_data", payload_schema(event_type))
    stamped = F.current_timestamp() if now is None else now
    return (
        bronze.where(F.col("event_type") == event_type)
        .select("event_id", F.inline(F.array(parsed)))
        .where(quality_rule(table))
        .withColumn("processing_time", stamped)
        .select(*silver_schema(table).names)
    )


def accept_reject_counts(bronze: DataFrame) -> DataFrame:
    """Per event type: rows received, accepted by silver, and rejected - in one pass.

    Only the fields the rules need are parsed. Types without a table accept nothing.
    """
    fields = bronze.select(
        "event_type", F.from_json("raw_data", _RULE_FIELDS).alias("p")
    ).select("event_type", "p.*")
    accepted = F.lit(False)
    for table, event_type in SILVER_EVENT.items():
        accepted = F.when(F.col("event_type") == event_type, quality_rule(table)).otherwise(accepted)
    received, passed = F.count(F.lit(1)), F.count_if(accepted)
    return fields.groupBy("event_type").agg(
        received.alias("received"),
        passed.alias("accepted"),
        (received - passed).alias("rejected"),
    )
