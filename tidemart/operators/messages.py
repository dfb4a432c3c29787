"""Producer-side message handling: topics, keys, and what was sent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_TOPIC = "raw-events"

# The topic each event type is sent to.
TOPIC_OF_EVENT = {
    "page_view": "page-views",
    "add_to_cart": "order-events",
    "purchase": "purchases",
    "user_session": "user-sessions",
    "product_update": "product-updates",
}

ALL_TOPICS = (BASE_TOPIC, *TOPIC_OF_EVENT.values())


def topic_for(event_type: Column, base_topic: str = BASE_TOPIC) -> Column:
    """The event type's own topic, or the base topic for a missing or unknown type."""
    pairs = [F.lit(x) for pair in TOPIC_OF_EVENT.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), event_type), F.lit(base_topic))


def key_for(user_id: Column, product_id: Column) -> Column:
    """User id, else product id, else ``unknown``; an empty user id counts as missing."""
    return F.coalesce(F.nullif(user_id, F.lit("")), product_id, F.lit("unknown"))


def topic_counts(base_topic: str = BASE_TOPIC) -> list[Column]:
    """Messages per topic as aggregate columns, to be observed while messages are sent."""
    topics = (base_topic, *TOPIC_OF_EVENT.values())
    return [F.count_if(F.col("topic") == topic).alias(topic) for topic in topics]


def topic_distribution(messages: DataFrame) -> DataFrame:
    return messages.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


def event_rate(messages: DataFrame) -> DataFrame:
    """Messages, minutes between first and last, messages per minute (0 over no time)."""
    span = messages.agg(
        F.count(F.lit(1)).alias("messages"),
        (
            (F.unix_micros(F.max("timestamp")) - F.unix_micros(F.min("timestamp"))) / F.lit(6e7)
        ).alias("elapsed_minutes"),
    )
    rate = F.when(
        F.col("elapsed_minutes") > 0, F.col("messages") / F.col("elapsed_minutes")
    ).otherwise(F.lit(0.0))
    return span.withColumn("events_per_minute", rate)
