"""The five silver tables, in batch, with their nested columns flattened for comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.operators.metrics import purchased_items
from tidemart.operators.silver import to_silver
from tidemart.plans import gold
from tidemart.queries.common import FIRST_DAY, MESSAGES_SQL, Query
from tidemart.queries.gold import (
    PRODUCT_PURCHASES_SQL,
    PRODUCT_VIEWS_SQL,
    PRODUCTS_SQL,
    PURCHASE_METRICS_SQL,
    SALES_METRICS_SQL,
    SALES_SQL,
    TRAFFIC_METRICS_SQL,
    USERS_AND_DAYS,
    VIEW_METRICS_SQL,
    customer_sql,
)
from tidemart.queries.messages import raw_events

_WITH = "WITH " + MESSAGES_SQL

_METADATA_SQL = """k AS metadata_k, CASE WHEN n % 3 = 0 THEN 'true' ELSE 'false' END AS metadata_flag,
    CAST(n % 100 AS VARCHAR) AS metadata_depth"""
_PAGE_SQL = """CASE n % 4 WHEN 0 THEN 'product_detail' WHEN 1 THEN 'category'
    WHEN 2 THEN 'search_results' ELSE 'home' END AS page_type"""
_DEVICE_SQL = "CASE n % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type"
_IP_SQL = "CONCAT('10.0.0.', CAST(n % 256 AS VARCHAR)) AS ip_address"
_HEAD_SQL = "bronze_id AS event_id, payload_time AS timestamp"
_BUYER_SQL = "payload_user AS user_id, session_id"


def silver(spark, folder, table):
    return to_silver(raw_events(spark, folder), table)


_FLAT = {
    "page_views": (
        "event_id", "timestamp", "user_id", "session_id", "product_id", "page_type",
        "referrer", "user_agent", "ip_address", "device_type",
    ),
    "cart_events": (
        "event_id", "timestamp", "user_id", "session_id", "product_id", "quantity", "price",
        "total_value", "cart_id",
    ),
    "user_sessions": (
        "event_id", "timestamp", "user_id", "session_id", "session_type", "device_type",
        "ip_address", "user_agent",
    ),
    "product_updates": ("event_id", "timestamp", "product_id", "update_type"),
}


def flat(rows, table):
    """A silver table's rows with nested columns flattened, and three metadata entries."""
    entries = [F.try_element_at("metadata", F.lit(k)).alias(f"metadata_{k}") for k in ("k", "flag", "depth")]
    return rows.select(*(_purchase_columns() if table == "purchases" else _FLAT[table]), *entries)


def _flat(table):
    return lambda spark, folder: flat(silver(spark, folder, table), table)


def accepted_sql(kind: str, columns: str) -> str:
    return f"{_WITH} SELECT {columns} FROM accepted WHERE event_type = '{kind}'"


def _items(spark, folder):
    return purchased_items(silver(spark, folder, "purchases"), keep=("order_id",))


# All fields of all items, as text.
_ITEMS_SQL = """CASE WHEN n % 29 <> 0 THEN array_to_string(list_transform(range(1, n % 4 + 1), lambda i: concat_ws('|',
        IF(i = 1, k, CONCAT(k, '-', CAST(i AS VARCHAR))), CAST(i AS VARCHAR), CAST(amount AS VARCHAR),
        CAST(CAST(amount * i AS DECIMAL(12,2)) AS VARCHAR),
        CASE (n + i) % 3 WHEN 0 THEN 'Books' WHEN 1 THEN 'Sports' ELSE 'Clothing' END,
        CONCAT('brand-', CAST(n % 7 AS VARCHAR)))), ';') END"""
_ADDRESS_SQL = """CASE WHEN n % 6 <> 0 THEN CONCAT(CAST(n % 100 AS VARCHAR), ' Main St') END AS street,
    CASE WHEN n % 6 = 0 THEN NULL WHEN n % 3 = 0 THEN 'Lund' WHEN n % 3 = 1 THEN 'Oslo' ELSE 'Turku' END AS city,
    CASE WHEN n % 6 <> 0 THEN 'XX' END AS state,
    CASE WHEN n % 6 <> 0 THEN lpad(CAST(n % 100000 AS VARCHAR), 5, '0') END AS zip_code,
    CASE WHEN n % 6 <> 0 THEN 'US' END AS country"""

_PURCHASE_COLUMNS_SQL = f"""{_HEAD_SQL}, {_BUYER_SQL},
    CONCAT('o', CAST(n AS VARCHAR)) AS order_id, CAST(amount AS DOUBLE) AS total_amount,
    CAST(amount + 5 AS DOUBLE) AS subtotal, n % 4 * 5 AS discount_percent,
    5.01 :: DOUBLE AS discount_amount,
    CASE n % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'debit_card' WHEN 2 THEN 'paypal'
         ELSE 'apple_pay' END AS payment_method,
    CASE n % 3 WHEN 0 THEN 'standard' WHEN 1 THEN 'expedited' ELSE 'overnight' END AS shipping_method,
    CASE WHEN n % 29 <> 0 THEN n % 4 END AS item_count,
    CASE WHEN n % 29 <> 0 THEN CAST(amount * (n % 4 * (n % 4 + 1) // 2) AS DOUBLE) END AS items_total,
    {_ITEMS_SQL} AS items, {_ADDRESS_SQL}, {_METADATA_SQL}"""


def _purchase_columns():
    no_money = F.lit(0).cast("decimal(12,2)")
    total = F.aggregate(
        "items", no_money, lambda t, i: (t + i["total_price"]).cast("decimal(12,2)")
    )
    return [
        "event_id", "timestamp", "user_id", "session_id", "order_id", "total_amount", "subtotal",
        "discount_percent", "discount_amount", "payment_method", "shipping_method",
        F.when(F.col("items").isNotNull(), F.size("items")).alias("item_count"),
        total.alias("items_total"), _items_text().alias("items"), *_address(),
    ]


def _items_text():
    """All fields of all items, as text."""
    names = ("product_id", "quantity", "unit_price", "total_price", "category", "brand")
    each = F.transform("items", lambda i: F.concat_ws("|", *[i[name].cast("string") for name in names]))
    return F.array_join(each, ";")


def _address():
    return [F.col(f"shipping_address.{name}").alias(name) for name in ("street", "city", "state", "zip_code", "country")]


def _nested(spark, folder):
    first = F.try_element_at("items", F.lit(1))
    return silver(spark, folder, "purchases").select(
        "order_id",
        *_address(),
        _items_text().alias("items"),
        first["product_id"].alias("first_product"),
        first["unit_price"].alias("first_price"),
        F.try_element_at("metadata", F.lit("k")).alias("metadata_k"),
        F.try_element_at("metadata", F.lit("none")).alias("metadata_none"),
    )


# Gold on silver made from the messages: rows without a time are in silver but not in gold.
_TIMED_SQL = f"""{_WITH},
views AS (
  SELECT payload_time AS ts, CAST(payload_time AS DATE) AS d, payload_user AS user_id, session_id,
         payload_product AS product_id
  FROM accepted WHERE event_type = 'page_view' AND payload_time IS NOT NULL),
purchases AS (
  SELECT n, k, CAST(payload_time AS DATE) AS d, payload_user AS user_id,
         CAST(amount AS DECIMAL(10,2)) AS total_amount,
         CASE n % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'debit_card' WHEN 2 THEN 'paypal'
              ELSE 'apple_pay' END AS payment_method
  FROM accepted WHERE event_type = 'purchase' AND payload_time IS NOT NULL),
items AS (
  SELECT IF(i = 1, k, CONCAT(k, '-', CAST(i AS VARCHAR))) AS product_id, i AS quantity,
         total_amount AS unit_price, total_amount * i AS total_price,
         CASE (n + i) % 3 WHEN 0 THEN 'Books' WHEN 1 THEN 'Sports' ELSE 'Clothing' END AS category,
         CONCAT('brand-', CAST(n % 7 AS VARCHAR)) AS brand
  FROM (SELECT *, unnest(range(1, n % 4 + 1)) AS i FROM purchases WHERE n % 29 <> 0))"""


def _on_messages(build, **options):
    def run(spark, folder):
        views, bought = silver(spark, folder, "page_views"), silver(spark, folder, "purchases")
        return build(views, bought, FIRST_DAY, **options)

    return run


QUERIES = {
    "silver_page_views": Query(
        _flat("page_views"),
        accepted_sql(
            "page_view",
            f"""{_HEAD_SQL}, {_BUYER_SQL}, payload_product AS product_id, {_PAGE_SQL},
            CASE WHEN n % 5 = 0 THEN NULL WHEN n % 3 = 0 THEN 'google.com'
                 WHEN n % 3 = 1 THEN 'direct' ELSE 'email' END AS referrer,
            CAST(NULL AS VARCHAR) AS user_agent, {_IP_SQL}, {_DEVICE_SQL}, {_METADATA_SQL}""",
        ),
    ),
    "silver_purchases": Query(
        _flat("purchases"),
        accepted_sql("purchase", _PURCHASE_COLUMNS_SQL),
    ),
    "silver_cart_events": Query(
        _flat("cart_events"),
        accepted_sql(
            "add_to_cart",
            f"""{_HEAD_SQL}, {_BUYER_SQL}, payload_product AS product_id,
            CAST(CAST(k AS INT) % 5 AS BIGINT) AS quantity, CAST(amount AS DOUBLE) AS price,
            CAST(amount * (CAST(k AS INT) % 5) AS DOUBLE) AS total_value,
            CONCAT('c', CAST(n % 89 AS VARCHAR)) AS cart_id, {_METADATA_SQL}""",
        ),
    ),
    "silver_user_sessions": Query(
        _flat("user_sessions"),
        accepted_sql(
            "user_session",
            f"""{_HEAD_SQL}, {_BUYER_SQL},
            CASE WHEN n % 2 = 0 THEN 'login' ELSE 'logout' END AS session_type, {_DEVICE_SQL},
            {_IP_SQL}, CAST(NULL AS VARCHAR) AS user_agent, {_METADATA_SQL}""",
        ),
    ),
    "silver_product_updates": Query(
        _flat("product_updates"),
        accepted_sql(
            "product_update",
            f"""{_HEAD_SQL}, payload_product AS product_id,
            CASE n % 3 WHEN 0 THEN 'price_change' WHEN 1 THEN 'inventory_update'
                 ELSE 'rating_update' END AS update_type, {_METADATA_SQL}""",
        ),
    ),
    "nested_field_access": Query(
        _nested,
        accepted_sql(
            "purchase",
            f"""CONCAT('o', CAST(n AS VARCHAR)) AS order_id, {_ADDRESS_SQL}, {_ITEMS_SQL} AS items,
            CASE WHEN n % 29 <> 0 AND n % 4 > 0 THEN k END AS first_product,
            CASE WHEN n % 29 <> 0 AND n % 4 > 0 THEN CAST(amount AS DOUBLE) END AS first_price,
            k AS metadata_k, CAST(NULL AS VARCHAR) AS metadata_none""",
        ),
    ),
    "purchase_items_exploded": Query(
        _items,
        f"""{_WITH} SELECT CONCAT('o', CAST(n AS VARCHAR)) AS order_id,
            IF(i = 1, k, CONCAT(k, '-', CAST(i AS VARCHAR))) AS product_id, i AS quantity,
            CAST(amount AS DOUBLE) AS unit_price, CAST(amount * i AS DOUBLE) AS total_price,
            CASE (n + i) % 3 WHEN 0 THEN 'Books' WHEN 1 THEN 'Sports' ELSE 'Clothing' END AS category,
            CONCAT('brand-', CAST(n % 7 AS VARCHAR)) AS brand
            FROM (SELECT *, unnest(range(1, n % 4 + 1)) AS i FROM accepted
                  WHERE event_type = 'purchase' AND n % 29 <> 0)""",
    ),
    "medallion_sales_summary": Query(
        _on_messages(gold.daily_sales_summary),
        f"{_TIMED_SQL}, {SALES_METRICS_SQL}, {TRAFFIC_METRICS_SQL}, {SALES_SQL} SELECT * FROM sales",
    ),
    "medallion_customer_analytics": Query(
        _on_messages(gold.daily_customer_analytics, same_day=True),
        f"""{_TIMED_SQL}, {VIEW_METRICS_SQL}, {PURCHASE_METRICS_SQL},
        {customer_sql(USERS_AND_DAYS)} SELECT * FROM customers""",
    ),
    "medallion_product_performance": Query(
        _on_messages(gold.product_performance_analytics),
        f"""{_TIMED_SQL}, {PRODUCT_VIEWS_SQL}, {PRODUCT_PURCHASES_SQL}, {PRODUCTS_SQL}
        SELECT * FROM products""",
    ),
}
