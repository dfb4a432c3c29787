"""Reading single fields out of a JSON message."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(message: Column, name: str) -> Column:
    """A top-level field as text; NULL where it is missing or the message is broken."""
    return F.get_json_object(message, f"$.{name}")


def event_identity(key: Column, message: Column, offset: Column, order: str) -> Column:
    """Message key, payload id, or a name made from the offset - first one present.

    ``order`` is ``key_first`` or ``payload_first``. Producers key messages by user (or
    product), so under ``key_first`` the id is mostly the user's and is not unique.
    """
    from_key, from_payload = key.cast("string"), field(message, "event_id")
    choices = {
        "key_first": (from_key, from_payload),
        "payload_first": (from_payload, from_key),
    }
    return F.coalesce(
        *choices[order], F.concat(F.lit("kafka_"), offset.cast("string"))
    )


def event_kind(message: Column) -> Column:
    return F.coalesce(field(message, "event_type"), F.lit("unknown"))


def event_instant(message: Column, arrival: Column) -> Column:
    """The payload's time, or the arrival time where that is missing or malformed."""
    return F.coalesce(F.try_to_timestamp(field(message, "timestamp")), arrival)
