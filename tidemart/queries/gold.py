"""Gold tables and the measures they are made of, on the derived silver inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.functions.measures import since
from tidemart.operators import metrics, totals
from tidemart.plans import gold
from tidemart.queries.common import (
    FIRST_DAY,
    ITEMS_SQL,
    PAGE_VIEWS_SQL,
    PURCHASES_SQL,
    Query,
    exact_decimal_mean,
    exact_mean,
    exact_ratio,
)
from tidemart.sources.given import page_views, purchases, purchases_by_line

BOUND = "2024-01-10"

VIEW_METRICS_SQL = """
pv AS (
  SELECT user_id, d, count(*) AS page_views, count(DISTINCT session_id) AS unique_sessions,
         count(DISTINCT product_id) AS unique_products_viewed,
         min(ts) AS first_visit_time, max(ts) AS last_activity_time
  FROM views GROUP BY user_id, d)"""

PURCHASE_METRICS_SQL = f"""
pm AS (
  SELECT user_id, d, count(*) AS total_purchases, CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
         {exact_mean('sum(total_amount)', 'count(*)')} AS avg_order_value
  FROM purchases GROUP BY user_id, d)"""

SALES_METRICS_SQL = f"""
ranked AS (
  SELECT d, payment_method,
         row_number() OVER (PARTITION BY d ORDER BY count(*) DESC, payment_method) AS place
  FROM purchases GROUP BY d, payment_method),
sm AS (
  SELECT p.d, count(*) AS total_orders, CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
         {exact_mean('sum(total_amount)', 'count(*)')} AS avg_order_value,
         count(DISTINCT user_id) AS unique_customers, min(r.payment_method) AS top_payment_method
  FROM purchases p JOIN ranked r ON r.d = p.d AND r.place = 1 GROUP BY p.d)"""

TRAFFIC_METRICS_SQL = """
tm AS (
  SELECT d, count(*) AS total_page_views, count(DISTINCT user_id) AS unique_visitors,
         count(DISTINCT session_id) AS total_sessions
  FROM views GROUP BY d)"""

PRODUCT_VIEWS_SQL = """
v AS (
  SELECT product_id, count(*) AS total_views, count(DISTINCT user_id) AS unique_viewers
  FROM views WHERE product_id IS NOT NULL GROUP BY product_id)"""

PRODUCT_PURCHASES_SQL = f"""
p AS (
  SELECT product_id, max(category) AS category, max(brand) AS brand,
         CAST(sum(quantity) AS BIGINT) AS total_purchases,
         CAST(sum(total_price) AS DOUBLE) AS total_revenue,
         {exact_mean('sum(unit_price)', 'count(*)')} AS avg_price
  FROM items GROUP BY product_id)"""


# The full outer joins, spelled out as matches plus the rows of either side without one.
CUSTOMER_COLUMNS_SQL = """page_views, unique_sessions, unique_products_viewed, total_purchases,
    total_revenue, avg_order_value, first_visit_time, last_activity_time"""


def customer_sql(matched: str) -> str:
    return f"""
paired AS (
  SELECT pv.user_id, pv.d, {CUSTOMER_COLUMNS_SQL} FROM pv JOIN pm ON {matched}
  UNION ALL
  SELECT user_id, d, page_views, unique_sessions, unique_products_viewed, 0, 0.0, 0.0,
         first_visit_time, last_activity_time
  FROM pv WHERE NOT EXISTS (SELECT 1 FROM pm WHERE {matched})
  UNION ALL
  SELECT user_id, d, 0, 0, 0, total_purchases, total_revenue, avg_order_value, NULL, NULL
  FROM pm WHERE NOT EXISTS (SELECT 1 FROM pv WHERE {matched})),
tiers AS (
  SELECT * FROM (VALUES (1000.0, 1e18, 'high_value'), (100.0, 1000.0, 'medium_value'),
                        (-1e18, 100.0, 'low_value')) AS t(least, below, tier)),
customers AS (
  SELECT user_id, d AS date, {CUSTOMER_COLUMNS_SQL},
         CASE WHEN total_purchases > 0 THEN tier
              ELSE IF(page_views > 10, 'engaged_browser', 'casual_browser') END AS customer_segment
  FROM paired JOIN tiers ON total_revenue >= least AND total_revenue < below)"""


SALES_SQL = """
days AS (SELECT d FROM sm UNION SELECT d FROM tm),
sales AS (
  SELECT days.d AS date, IFNULL(total_orders, 0) AS total_orders,
         IFNULL(total_revenue, 0.0) AS total_revenue, IFNULL(avg_order_value, 0.0) AS avg_order_value,
         IFNULL(unique_customers, 0) AS unique_customers, top_payment_method,
         IFNULL(total_page_views, 0) AS total_page_views, IFNULL(unique_visitors, 0) AS unique_visitors,
         IFNULL(total_sessions, 0) AS total_sessions,
         IF(tm.d IS NULL OR unique_visitors = 0, 0.0,
            CAST(unique_customers AS DOUBLE) / unique_visitors) AS conversion_rate,
         IF(tm.d IS NULL OR unique_visitors = 0, 0.0, total_revenue / unique_visitors) AS revenue_per_visitor
  FROM days LEFT JOIN sm ON sm.d = days.d LEFT JOIN tm ON tm.d = days.d)"""

PRODUCTS_SQL = f"""
known AS (SELECT product_id FROM v UNION SELECT product_id FROM p),
products AS (
  SELECT known.product_id, category, brand, DATE '{FIRST_DAY}' AS date,
         IFNULL(total_views, 0) AS total_views, IFNULL(total_purchases, 0) AS total_purchases,
         IF(v.product_id IS NULL, 0.0, {exact_ratio('total_purchases', 'total_views')}) AS conversion_rate,
         IFNULL(total_revenue, 0.0) AS total_revenue, IFNULL(avg_price, 0.0) AS avg_price,
         IFNULL(unique_viewers, 0) AS unique_viewers
  FROM known LEFT JOIN v ON v.product_id = known.product_id
             LEFT JOIN p ON p.product_id = known.product_id)"""

USERS_ONLY, USERS_AND_DAYS = "pv.user_id = pm.user_id", "pv.user_id = pm.user_id AND pv.d = pm.d"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_VIEW_SIDE = (PAGE_VIEWS_SQL, VIEW_METRICS_SQL)
_PURCHASE_SIDE = (PURCHASES_SQL, PURCHASE_METRICS_SQL)
_CUSTOMERS = _with(*_VIEW_SIDE, *_PURCHASE_SIDE, customer_sql(USERS_ONLY))
_CUSTOMERS_DATED = _with(*_VIEW_SIDE, *_PURCHASE_SIDE, customer_sql(USERS_AND_DAYS))
WHOLE_SALES_SQL = _with(PURCHASES_SQL, SALES_METRICS_SQL, PAGE_VIEWS_SQL, TRAFFIC_METRICS_SQL, SALES_SQL)
_PRODUCTS = _with(PAGE_VIEWS_SQL, PRODUCT_VIEWS_SQL, ITEMS_SQL, PRODUCT_PURCHASES_SQL, PRODUCTS_SQL)


def customers(spark, folder, same_day=False):
    return gold.daily_customer_analytics(
        page_views(spark, folder), purchases(spark, folder), FIRST_DAY, same_day=same_day
    )


def customers_dated(spark, folder):
    return customers(spark, folder, same_day=True)


def sales(spark, folder):
    return gold.daily_sales_summary(page_views(spark, folder), purchases(spark, folder), FIRST_DAY)


def products(spark, folder):
    return gold.product_performance_analytics(
        page_views(spark, folder), purchases_by_line(spark, folder), FIRST_DAY
    )


def _segments(spark, folder):
    return customers_dated(spark, folder).groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.min("total_revenue").alias("least_revenue"),
        F.max("total_revenue").alias("most_revenue"),
        F.max("page_views").alias("most_page_views"),
    )


def _lower_bound(spark, folder):
    def counts(rows, kind):
        kept = rows.where(since(F.col("timestamp"), BOUND))
        return kept.groupBy(F.lit(kind).alias("kind"), F.to_date("timestamp").alias("date")).agg(
            F.count(F.lit(1)).alias("events")
        )

    return counts(page_views(spark, folder), "page_view").unionByName(
        counts(purchases(spark, folder), "purchase")
    )


QUERIES = {
    "daily_sales_summary": Query(sales, WHOLE_SALES_SQL + " SELECT * FROM sales"),
    "daily_customer_analytics": Query(customers, _CUSTOMERS + " SELECT * FROM customers"),
    "daily_customer_analytics_dated": Query(
        customers_dated, _CUSTOMERS_DATED + " SELECT * FROM customers"
    ),
    "product_performance_analytics": Query(products, _PRODUCTS + " SELECT * FROM products"),
    "page_view_metrics": Query(
        lambda s, f: metrics.page_view_metrics(page_views(s, f), FIRST_DAY),
        _with(*_VIEW_SIDE) + " SELECT * EXCLUDE (d), d AS date FROM pv",
    ),
    "purchase_metrics": Query(
        lambda s, f: metrics.purchase_metrics(purchases(s, f), FIRST_DAY),
        _with(*_PURCHASE_SIDE) + " SELECT * EXCLUDE (d), d AS date FROM pm",
    ),
    "sales_metrics": Query(
        lambda s, f: metrics.sales_metrics(purchases(s, f), FIRST_DAY),
        _with(PURCHASES_SQL, SALES_METRICS_SQL) + " SELECT * EXCLUDE (d), d AS date FROM sm",
    ),
    "traffic_metrics": Query(
        lambda s, f: metrics.traffic_metrics(page_views(s, f), FIRST_DAY),
        _with(PAGE_VIEWS_SQL, TRAFFIC_METRICS_SQL) + " SELECT * EXCLUDE (d), d AS date FROM tm",
    ),
    "product_views": Query(
        lambda s, f: metrics.product_views(page_views(s, f), FIRST_DAY),
        _with(PAGE_VIEWS_SQL, PRODUCT_VIEWS_SQL) + " SELECT * FROM v",
    ),
    "product_purchases": Query(
        lambda s, f: metrics.product_purchases(purchases_by_line(s, f), FIRST_DAY),
        _with(ITEMS_SQL, PRODUCT_PURCHASES_SQL) + " SELECT * FROM p",
    ),
    "customer_segments": Query(
        _segments,
        _CUSTOMERS_DATED
        + """ SELECT customer_segment, count(*) AS customers, min(total_revenue) AS least_revenue,
              max(total_revenue) AS most_revenue, max(page_views) AS most_page_views
              FROM customers GROUP BY customer_segment""",
    ),
    "customer_run_totals": Query(
        lambda s, f: totals.joined_on_user_totals(page_views(s, f), purchases(s, f), FIRST_DAY),
        _CUSTOMERS
        + """ SELECT count(*) AS total_customers,
              count(*) FILTER (customer_segment = 'high_value') AS high_value_customers,
              CAST(sum(CAST(total_revenue AS DECIMAL(20,2))) AS DOUBLE) AS total_revenue
              FROM customers""",
    ),
    "sales_run_totals": Query(
        # The average of doubles depends on the order of addition in its last digits.
        lambda s, f: sales(s, f)
        .agg(*totals.sales_totals())
        .withColumn("avg_conversion_rate", F.round("avg_conversion_rate", 9)),
        WHOLE_SALES_SQL
        + f""" SELECT count(*) AS total_days, CAST(sum(total_orders) AS BIGINT) AS total_orders,
              CAST(sum(CAST(total_revenue AS DECIMAL(20,2))) AS DOUBLE) AS total_revenue,
              {exact_decimal_mean('avg_order_value', 6)} AS avg_order_value,
              CAST(sum(unique_customers) AS BIGINT) AS unique_customers,
              round(avg(conversion_rate), 9) AS avg_conversion_rate FROM sales""",
    ),
    "product_run_totals": Query(
        lambda s, f: products(s, f).agg(*totals.product_totals()),
        _PRODUCTS
        + f""" SELECT count(*) AS total_products, CAST(sum(total_purchases) AS BIGINT) AS total_purchases,
              CAST(sum(CAST(total_revenue AS DECIMAL(20,2))) AS DOUBLE) AS total_revenue,
              {exact_decimal_mean('conversion_rate', 11)} AS avg_conversion_rate FROM products""",
    ),
    "date_lower_bound": Query(
        _lower_bound,
        _with(PAGE_VIEWS_SQL, PURCHASES_SQL)
        + f""" SELECT 'page_view' AS kind, d AS date, count(*) AS events FROM views
               WHERE d >= DATE '{BOUND}' GROUP BY d
               UNION ALL SELECT 'purchase', d, count(*) FROM purchases
               WHERE d >= DATE '{BOUND}' GROUP BY d""",
    ),
}
