"""Tables and streams: the message stream is landed as files, then run through the pipeline."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemart.operators.messages import TOPIC_OF_EVENT
from tidemart.plans import gold
from tidemart.queries import gold as gold_queries
from tidemart.queries import silver
from tidemart.queries.common import FIRST_DAY, MESSAGES_SQL, Query, landing, messages, state
from tidemart.queries.gold import WHOLE_SALES_SQL
from tidemart.queries.messages import BRONZE_ROWS_SQL, bronze_rows
from tidemart.queries.silver import flat
from tidemart.schemas import SILVER_EVENT, column_ddl
from tidemart.sources import given
from tidemart.sources import messages as message_source
from tidemart.sources.lake import LAYOUTS, Lake
from tidemart.streaming import pipeline
from tidemart.workspace import fresh_folder

_WITH = "WITH " + MESSAGES_SQL

_DRAINED: dict[tuple[str, str], Lake] = {}


def new_lake(spark) -> Lake:
    """An empty lake in a folder and under schema names of its own."""
    return Lake(spark, fresh_folder(spark, "lake"), f"t{uuid.uuid4().hex[:10]}_").create()


def drained(spark, folder) -> Lake:
    """A lake that all messages went through; made once per application and state of the input."""
    key = (spark.sparkContext.applicationId, state(spark, folder))
    if key not in _DRAINED:
        lake = new_lake(spark)
        pipeline.drain(lake, message_source.from_files(spark, landing(spark, folder)))
        _DRAINED[key] = lake
    return _DRAINED[key]


def silver_content(lake: Lake):
    """All rows of the five silver tables; a column that a table lacks is null in its rows."""
    whole = None
    for table in SILVER_EVENT:
        part = flat(lake.read("silver", table), table).select(F.lit(table).alias("table_name"), "*")
        whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
    return whole


_TABLE_OF_TYPE_SQL = """CASE event_type WHEN 'page_view' THEN 'page_views'
    WHEN 'purchase' THEN 'purchases' WHEN 'add_to_cart' THEN 'cart_events'
    WHEN 'user_session' THEN 'user_sessions' ELSE 'product_updates' END"""

CONTENT_SQL = " UNION ALL BY NAME ".join(
    f"SELECT '{table}' AS table_name, * FROM ({silver.QUERIES[f'silver_{table}'].sql})" for table in SILVER_EVENT
)


def _ingest(spark, folder):
    return bronze_rows(drained(spark, folder).read("bronze", "raw_events"))


def _fanout(spark, folder):
    return silver_content(drained(spark, folder))


def _restart(spark, folder):
    """Messages land in two goes; the pipeline is stopped after the first and started anew.
    A third start finds nothing to do."""
    lake, source = new_lake(spark), fresh_folder(spark, "messages")
    rows = messages(spark, folder)
    early = F.col("topic").isin(TOPIC_OF_EVENT["page_view"], TOPIC_OF_EVENT["purchase"])
    message_source.to_files(rows.where(early), source)
    pipeline.drain(lake, message_source.from_files(spark, source))
    message_source.to_files(rows.where(~early), source)
    for _ in range(2):
        restarted = Lake(spark, lake.root, lake.prefix).create()
        pipeline.drain(restarted, message_source.from_files(spark, source))
    return silver_content(lake)


def _bronze_stream(spark, folder):
    """Bronze followed as a stream, commit by commit, kept as files, and counted per type."""
    lake = drained(spark, folder)
    copy, got = fresh_folder(spark, "bronze-copy"), [None]

    def take(newest):
        parts, upto = lake.added("bronze", "raw_events", got[0], newest)
        if parts:
            lake.rows_of("bronze", "raw_events", parts).write.mode("overwrite").parquet(f"{copy}/upto={upto}")
        got[0] = upto

    job = f"copy-{uuid.uuid4().hex[:10]}"
    lake.follow("bronze", "raw_events", take, job=job, trigger=pipeline.DRAIN, commits=2).awaitTermination()
    rows = spark.read.parquet(copy)
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


def _row_counts(spark, folder):
    lake = drained(spark, folder)
    return lake.inventory("bronze").unionByName(lake.inventory("silver"))


def _inventory(spark, folder):
    return drained(spark, folder).inventory("silver").select("table_name", "row_count")


def _schemas(spark, folder):
    """Columns of each table as the catalog has them, with the rows they hold."""
    lake = drained(spark, folder)
    whole = None
    for layer, table in LAYOUTS:
        if layer == "ops":
            continue
        rows = lake.read(layer, table)
        part = rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"),
            F.lit(table).alias("table_name"),
            F.lit(column_ddl(rows.schema).replace("`", "")).alias("columns"),
            "row_count",
        )
        whole = part if whole is None else whole.unionByName(part)
    return whole


# The tables' contract columns.
_COLUMNS = {
    "raw_events": "event_id string, event_type string, timestamp timestamp, topic string, "
    "partition int, offset bigint, raw_data string, processing_time timestamp",
    "page_views": "event_id string, timestamp timestamp, user_id string, session_id string, "
    "product_id string, page_type string, referrer string, user_agent string, "
    "ip_address string, device_type string, metadata map<string,string>, "
    "processing_time timestamp",
    "purchases": "event_id string, timestamp timestamp, user_id string, session_id string, "
    "order_id string, total_amount decimal(10,2), subtotal decimal(10,2), "
    "discount_percent int, discount_amount decimal(10,2), payment_method string, "
    "shipping_method string, shipping_address struct<street:string,city:string,state:string,"
    "zip_code:string,country:string>, items array<struct<product_id:string,quantity:int,"
    "unit_price:decimal(10,2),total_price:decimal(10,2),category:string,brand:string>>, "
    "metadata map<string,string>, processing_time timestamp",
    "cart_events": "event_id string, timestamp timestamp, user_id string, session_id string, "
    "product_id string, quantity int, price decimal(10,2), total_value decimal(10,2), "
    "cart_id string, metadata map<string,string>, processing_time timestamp",
    "user_sessions": "event_id string, timestamp timestamp, user_id string, "
    "session_id string, session_type string, device_type string, ip_address string, "
    "user_agent string, metadata map<string,string>, processing_time timestamp",
    "product_updates": "event_id string, timestamp timestamp, product_id string, "
    "update_type string, metadata map<string,string>, processing_time timestamp",
}
_COLUMNS_SQL = ", ".join(f"('{table}', '{columns}')" for table, columns in _COLUMNS.items())

_COUNTS_SQL = f"""counts AS (
    SELECT 'bronze' AS layer, 'raw_events' AS table_name, count(*) AS row_count FROM bronze
    UNION ALL SELECT 'silver', {_TABLE_OF_TYPE_SQL}, count(*) FROM accepted GROUP BY 2)"""

RENEWED = "2024-01-20"


def _overwrite(spark, folder):
    """The sales table is written whole; then its later days are written again without any
    purchases. Earlier days must stay, later ones must have no orders left."""
    lake = new_lake(spark)
    views, bought = given.page_views(spark, folder), given.purchases(spark, folder)
    first = gold.daily_sales_summary(views, bought, FIRST_DAY)
    lake.overwrite_gold(first, "daily_sales_summary", "replace")
    unsold = gold.daily_sales_summary(views, bought.where(F.lit(False)), RENEWED)
    lake.overwrite_gold(unsold, "daily_sales_summary", "dynamic")
    return lake.read("gold", "daily_sales_summary")


_OVERWRITE_SQL = f"""{WHOLE_SALES_SQL} SELECT s.date,
    CASE WHEN renewed THEN 0 ELSE total_orders END AS total_orders,
    CASE WHEN renewed THEN 0.0 ELSE total_revenue END AS total_revenue,
    CASE WHEN renewed THEN 0.0 ELSE avg_order_value END AS avg_order_value,
    CASE WHEN renewed THEN 0 ELSE unique_customers END AS unique_customers,
    CASE WHEN NOT renewed THEN top_payment_method END AS top_payment_method,
    total_page_views, unique_visitors, total_sessions,
    CASE WHEN NOT renewed THEN conversion_rate END AS conversion_rate,
    CASE WHEN NOT renewed THEN revenue_per_visitor END AS revenue_per_visitor
    FROM (SELECT *, date >= DATE '{RENEWED}' AND unique_visitors > 0 AS renewed FROM sales) s"""


def _overwrite_customers(spark, folder):
    """The customer table is written whole; its later days are written once more, beside the old folders of the rest."""
    lake, rows = new_lake(spark), gold_queries.customers_dated(spark, folder)
    lake.overwrite_gold(rows, "daily_customer_analytics", "replace")
    lake.overwrite_gold(rows.where(F.col("date") >= F.lit(RENEWED).cast("date")), "daily_customer_analytics", "dynamic")
    return lake.read("gold", "daily_customer_analytics")


def _overwrite_products(spark, folder):
    """The product table replaces one of another day, then its own."""
    lake, name = new_lake(spark), "product_performance_analytics"
    views, lines = given.page_views(spark, folder), given.purchases_by_line(spark, folder)
    lake.overwrite_gold(gold.product_performance_analytics(views, lines, RENEWED), name, "replace")
    lake.overwrite_gold(gold_queries.products(spark, folder), name, "replace")
    lake.overwrite_gold(gold_queries.products(spark, folder), name, "dynamic")
    return lake.read("gold", name)


QUERIES = {
    "gold_overwrite_customers": Query(_overwrite_customers, gold_queries.QUERIES["daily_customer_analytics_dated"].sql),
    "gold_overwrite_products": Query(_overwrite_products, gold_queries.QUERIES["product_performance_analytics"].sql),
    "stream_bronze_ingest": Query(_ingest, BRONZE_ROWS_SQL),
    "stream_silver_fanout": Query(_fanout, CONTENT_SQL),
    "stream_restart_no_dupes": Query(_restart, CONTENT_SQL),
    "bronze_stream_scan": Query(
        _bronze_stream,
        _WITH
        + """ SELECT event_type, count(*) AS events, min(n) AS first_offset, max(n) AS last_offset
              FROM bronze GROUP BY event_type""",
    ),
    "layer_row_counts": Query(_row_counts, f"{_WITH}, {_COUNTS_SQL} SELECT * FROM counts"),
    "silver_table_inventory": Query(
        _inventory,
        f"{_WITH}, {_COUNTS_SQL} SELECT table_name, row_count FROM counts WHERE layer = 'silver'",
    ),
    "table_schemas": Query(
        _schemas,
        f"""{_WITH}, {_COUNTS_SQL}
        SELECT layer, table_name, columns, row_count FROM counts
        JOIN (VALUES {_COLUMNS_SQL}) AS c(table_name, columns) USING (table_name)""",
    ),
    "gold_overwrite_roundtrip": Query(_overwrite, _OVERWRITE_SQL),
}
