"""Every schema, declared once; parse schemas, table columns and DDL derive from here."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
INT = T.IntegerType()
LONG = T.LongType()
INSTANT = T.TimestampType()
MONEY = T.DecimalType(10, 2)
TEXT_MAP = T.MapType(TEXT, TEXT)


def _struct(*required, optional=()) -> T.StructType:
    """Fields in order; those named in ``optional`` are nullable."""
    return T.StructType(
        [T.StructField(name, kind, name in optional) for name, kind in required]
    )


# The seven columns Spark's message source yields.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", TEXT),
        T.StructField("partition", INT),
        T.StructField("offset", LONG),
        T.StructField("timestamp", INSTANT),
        T.StructField("timestampType", INT),
    ]
)

ADDRESS = _struct(
    ("street", TEXT),
    ("city", TEXT),
    ("state", TEXT),
    ("zip_code", TEXT),
    ("country", TEXT),
    optional=("street", "city", "state", "zip_code", "country"),
)

LINE_ITEM = _struct(
    ("product_id", TEXT),
    ("quantity", INT),
    ("unit_price", MONEY),
    ("total_price", MONEY),
    ("category", TEXT),
    ("brand", TEXT),
)

# The wire format of the five events, fields in wire order.
EVENT_SCHEMAS: dict[str, T.StructType] = {
    "page_view": _struct(
        ("event_id", TEXT),
        ("event_type", TEXT),
        ("timestamp", INSTANT),
        ("user_id", TEXT),
        ("session_id", TEXT),
        ("product_id", TEXT),
        ("page_type", TEXT),
        ("referrer", TEXT),
        ("user_agent", TEXT),
        ("ip_address", TEXT),
        ("device_type", TEXT),
        ("metadata", TEXT_MAP),
        optional=("referrer", "user_agent", "ip_address", "device_type", "metadata"),
    ),
    "purchase": _struct(
        ("event_id", TEXT),
        ("event_type", TEXT),
        ("timestamp", INSTANT),
        ("user_id", TEXT),
        ("session_id", TEXT),
        ("order_id", TEXT),
        ("total_amount", MONEY),
        ("subtotal", MONEY),
        ("discount_percent", INT),
        ("discount_amount", MONEY),
        ("payment_method", TEXT),
        ("shipping_method", TEXT),
        ("shipping_address", ADDRESS),
        ("items", T.ArrayType(LINE_ITEM)),
        ("metadata", TEXT_MAP),
        optional=("shipping_address", "metadata"),
    ),
    "add_to_cart": _struct(
        ("event_id", TEXT),
        ("event_type", TEXT),
        ("timestamp", INSTANT),
        ("user_id", TEXT),
        ("session_id", TEXT),
        ("product_id", TEXT),
        ("quantity", INT),
        ("price", MONEY),
        ("total_value", MONEY),
        ("cart_id", TEXT),
        ("metadata", TEXT_MAP),
        optional=("metadata",),
    ),
    "user_session": _struct(
        ("event_id", TEXT),
        ("event_type", TEXT),
        ("timestamp", INSTANT),
        ("user_id", TEXT),
        ("session_id", TEXT),
        ("session_type", TEXT),
        ("device_type", TEXT),
        ("ip_address", TEXT),
        ("user_agent", TEXT),
        ("metadata", TEXT_MAP),
        optional=("ip_address", "user_agent", "metadata"),
    ),
    "product_update": _struct(
        ("event_id", TEXT),
        ("event_type", TEXT),
        ("timestamp", INSTANT),
        ("product_id", TEXT),
        ("update_type", TEXT),
        ("metadata", TEXT_MAP),
        optional=("metadata",),
    ),
}

# Which event type each silver table holds.
SILVER_EVENT = {
    "page_views": "page_view",
    "purchases": "purchase",
    "cart_events": "add_to_cart",
    "user_sessions": "user_session",
    "product_updates": "product_update",
}

RAW_EVENTS = T.StructType(
    [
        T.StructField("event_id", TEXT),
        T.StructField("event_type", TEXT),
        T.StructField("timestamp", INSTANT),
        T.StructField("topic", TEXT),
        T.StructField("partition", INT),
        T.StructField("offset", LONG),
        T.StructField("raw_data", TEXT),
        T.StructField("processing_time", INSTANT),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("processing_date", T.DateType()),
        T.StructField("status", TEXT),
        T.StructField("data_version", TEXT),
        T.StructField("processing_timestamp", INSTANT),
        T.StructField("spark_app_name", TEXT),
        T.StructField("spark_app_id", TEXT),
        T.StructField("table_format", TEXT),
        T.StructField("table_location", TEXT),
        T.StructField("metrics", TEXT_MAP),
        T.StructField("error_type", TEXT),
        T.StructField("error_message", TEXT),
    ]
)


def payload_schema(event_type: str) -> T.StructType:
    """What silver parses: the id comes from bronze and the type is already known."""
    return T.StructType(
        [f for f in EVENT_SCHEMAS[event_type] if f.name not in ("event_id", "event_type")]
    )


def silver_schema(table: str) -> T.StructType:
    """Payload columns without the event type, plus the processing time."""
    kept = [f for f in EVENT_SCHEMAS[SILVER_EVENT[table]] if f.name != "event_type"]
    columns = [T.StructField(f.name, f.dataType, True) for f in kept]
    return T.StructType([*columns, T.StructField("processing_time", INSTANT)])


def column_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
