"""Messages -> raw events, and what can be read off the raw layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import payload
from tidemart.schemas import SILVER_EVENT

OTHER_ROUTE = "other"


def to_bronze(
    messages: DataFrame, *, now: Column | None = None, id_order: str = "key_first"
) -> DataFrame:
    """Envelope -> the eight raw-event columns. Every message is kept as it came."""
    body = F.col("value").cast("string")
    return messages.select(
        payload.event_identity(F.col("key"), body, F.col("offset"), id_order).alias("event_id"),
        payload.event_kind(body).alias("event_type"),
        payload.event_instant(body, F.col("timestamp")).alias("timestamp"),
        "topic",
        "partition",
        "offset",
        body.alias("raw_data"),
        (F.current_timestamp() if now is None else now).alias("processing_time"),
    )


def route() -> Column:
    """Storage partition of a raw event: its type if silver knows it, else one common bin.

    Types come from outside, so partitioning by the type itself could open any number of
    folders; this has six values.
    """
    known = F.col("event_type").isin(*SILVER_EVENT.values())
    return F.when(known, F.col("event_type")).otherwise(F.lit(OTHER_ROUTE))


def type_counts(bronze: DataFrame) -> DataFrame:
    """Raw events per type, and the silver table each type feeds (NULL: stays in bronze)."""
    fed = F.create_map(
        *[F.lit(x) for table, kind in SILVER_EVENT.items() for x in (kind, table)]
    )
    return (
        bronze.groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("events"))
        .select("event_type", F.try_element_at(fed, "event_type").alias("silver_table"), "events")
    )


def offset_ranges(bronze: DataFrame) -> DataFrame:
    """Lineage summary: first and last offset and message count per topic partition."""
    return bronze.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.count(F.lit(1)).alias("messages"),
    )
