"""The message stream and the raw layer, in batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.functions import payload
from tidemart.operators import bronze, silver
from tidemart.operators.messages import event_rate, key_for, topic_distribution, topic_for
from tidemart.queries.common import BODY_SQL, MESSAGES_SQL, Query, messages

_WITH = "WITH " + MESSAGES_SQL

BRONZE_ROWS_SQL = (
    _WITH
    + f""" SELECT bronze_id AS event_id, event_type, bronze_time AS timestamp, topic,
          part AS partition, n AS "offset", {BODY_SQL} AS raw_data FROM bronze"""
)

TYPE_COUNTS_SQL = (
    _WITH
    + """ SELECT event_type, CASE event_type WHEN 'page_view' THEN 'page_views'
          WHEN 'purchase' THEN 'purchases' WHEN 'add_to_cart' THEN 'cart_events'
          WHEN 'user_session' THEN 'user_sessions' WHEN 'product_update' THEN 'product_updates'
          END AS silver_table, count(*) AS events FROM bronze GROUP BY event_type"""
)


def raw_events(spark, folder):
    return bronze.to_bronze(messages(spark, folder))


def bronze_rows(rows):
    return rows.select("event_id", "event_type", "timestamp", "topic", "partition", "offset", "raw_data")


def _envelope_scan(spark, folder):
    body = F.col("value").cast("string")
    return messages(spark, folder).select(
        F.col("key").cast("string").alias("message_key"),
        payload.field(body, "event_id").alias("payload_id"),
        payload.field(body, "timestamp").alias("payload_time_text"),
        body.alias("body"),
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.col("timestampType").alias("timestamp_type"),
    )


def _field_extraction(spark, folder):
    body = F.col("value").cast("string")
    key, offset = F.col("key"), F.col("offset")
    return messages(spark, folder).select(
        "offset",
        payload.event_identity(key, body, offset, "key_first").alias("id_key_first"),
        payload.event_identity(key, body, offset, "payload_first").alias("id_payload_first"),
        payload.event_kind(body).alias("event_type"),
        payload.event_instant(body, F.col("timestamp")).alias("timestamp"),
    )


def _topic_routing(spark, folder):
    return raw_events(spark, folder).select(
        "offset", topic_for(F.col("event_type")).alias("topic")
    )


def _message_key(spark, folder):
    rows = raw_events(spark, folder)
    user, product = payload.field(F.col("raw_data"), "user_id"), payload.field(F.col("raw_data"), "product_id")
    # A missing user is written as an empty one, which must fall through as well.
    blank = F.coalesce(user, F.lit(""))
    return rows.select("offset", key_for(blank, product).alias("message_key"))


QUERIES = {
    "kafka_envelope_scan": Query(
        _envelope_scan,
        _WITH
        + f""" SELECT msg_key AS message_key, payload_id, {BODY_SQL} AS body,
              CASE WHEN broken THEN NULL WHEN n % 41 = 0 THEN 'not-a-time'
                   ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS payload_time_text,
              topic, part AS partition, n AS "offset", arrival AS timestamp,
              CAST(0 AS BIGINT) AS timestamp_type FROM bronze""",
    ),
    "bronze_raw_events": Query(
        lambda s, f: bronze_rows(raw_events(s, f)), BRONZE_ROWS_SQL
    ),
    "event_type_routing": Query(
        lambda s, f: bronze.type_counts(raw_events(s, f)), TYPE_COUNTS_SQL
    ),
    "bronze_offset_ranges": Query(
        lambda s, f: bronze.offset_ranges(raw_events(s, f)),
        _WITH
        + """ SELECT topic, part AS partition, min(n) AS first_offset, max(n) AS last_offset,
              count(*) AS messages FROM bronze GROUP BY topic, part""",
    ),
    "dq_accept_reject_counts": Query(
        lambda s, f: silver.accept_reject_counts(raw_events(s, f)),
        _WITH
        + """ SELECT b.event_type, count(*) AS received, count(a.n) AS accepted,
              count(*) - count(a.n) AS rejected
              FROM bronze b LEFT JOIN accepted a ON a.n = b.n GROUP BY b.event_type""",
    ),
    "json_field_extraction": Query(
        _field_extraction,
        _WITH
        + """ SELECT n AS "offset", bronze_id AS id_key_first,
              COALESCE(payload_id, msg_key, CONCAT('kafka_', CAST(n AS VARCHAR))) AS id_payload_first,
              event_type, bronze_time AS timestamp FROM bronze""",
    ),
    "topic_routing": Query(
        _topic_routing,
        _WITH
        + """ SELECT n AS "offset", CASE WHEN event_type IN ('unknown', 'mystery') THEN 'raw-events'
              ELSE topic END AS topic FROM bronze""",
    ),
    "message_key": Query(
        _message_key,
        _WITH
        + """ SELECT n AS "offset", COALESCE(payload_user, payload_product, 'unknown') AS message_key
              FROM bronze""",
    ),
    "topic_distribution": Query(
        lambda s, f: topic_distribution(messages(s, f)),
        _WITH + " SELECT topic, count(*) AS messages FROM bronze GROUP BY topic",
    ),
    "event_rate": Query(
        lambda s, f: event_rate(messages(s, f)),
        """ WITH span AS (SELECT count(*) AS messages,
              (epoch_us(max(ts)) - epoch_us(min(ts))) / CAST(6e7 AS DOUBLE) AS elapsed_minutes FROM events)
            SELECT messages, elapsed_minutes, CASE WHEN elapsed_minutes > 0
              THEN messages / elapsed_minutes ELSE 0.0 END AS events_per_minute FROM span""",
    ),
}
