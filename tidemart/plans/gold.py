"""The three gold tables, as functions of silver views and purchases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.measures import (
    customer_segment,
    or_no_money,
    or_zero,
    per_visitor,
    unit_conversion,
)
from tidemart.operators import metrics


def _stamp(now: Column | None) -> Column:
    return (F.current_timestamp() if now is None else now).alias("created_at")


def daily_customer_analytics(
    views: DataFrame,
    purchases: DataFrame,
    day,
    *,
    same_day: bool = False,
    now: Column | None = None,
) -> DataFrame:
    """Views and purchases per customer, with a segment.

    Both sides hold one row per (user, day). The contract joins them on the user alone, so
    over a range of n days a user may get n x n rows; on a single day - the daily run - the
    two forms agree. ``same_day=True`` joins on user and day.
    """
    v = metrics.page_view_metrics(views, day).alias("v")
    p = metrics.purchase_metrics(purchases, day).alias("p")
    matched = F.col("v.user_id") == F.col("p.user_id")
    if same_day:
        matched = matched & (F.col("v.date") == F.col("p.date"))
    return v.join(p, matched, "full_outer").select(
        F.coalesce("v.user_id", "p.user_id").alias("user_id"),
        F.coalesce("v.date", "p.date").alias("date"),
        or_zero(F.col("page_views")).alias("page_views"),
        or_zero(F.col("unique_sessions")).alias("unique_sessions"),
        or_zero(F.col("unique_products_viewed")).alias("unique_products_viewed"),
        or_zero(F.col("total_purchases")).alias("total_purchases"),
        or_no_money(F.col("total_revenue")).alias("total_revenue"),
        or_no_money(F.col("avg_order_value")).alias("avg_order_value"),
        "first_visit_time",
        "last_activity_time",
        customer_segment(
            F.col("total_purchases"), F.col("total_revenue"), F.col("page_views")
        ).alias("customer_segment"),
        _stamp(now),
    )


def daily_sales_summary(
    views: DataFrame, purchases: DataFrame, day, *, now: Column | None = None
) -> DataFrame:
    """Sales and traffic per day. Rates are NULL on days without sales."""
    s = metrics.sales_metrics(purchases, day).alias("s")
    t = metrics.traffic_metrics(views, day).alias("t")
    return s.join(t, F.col("s.date") == F.col("t.date"), "full_outer").select(
        F.coalesce("s.date", "t.date").alias("date"),
        or_zero(F.col("total_orders")).alias("total_orders"),
        or_no_money(F.col("total_revenue")).alias("total_revenue"),
        or_no_money(F.col("avg_order_value")).alias("avg_order_value"),
        or_zero(F.col("unique_customers")).alias("unique_customers"),
        "top_payment_method",
        or_zero(F.col("total_page_views")).alias("total_page_views"),
        or_zero(F.col("unique_visitors")).alias("unique_visitors"),
        or_zero(F.col("total_sessions")).alias("total_sessions"),
        per_visitor(F.col("unique_customers"), F.col("unique_visitors")).alias("conversion_rate"),
        per_visitor(F.col("total_revenue"), F.col("unique_visitors")).alias("revenue_per_visitor"),
        _stamp(now),
    )


def product_performance_analytics(
    views: DataFrame, purchases: DataFrame, day, *, now: Column | None = None
) -> DataFrame:
    """Views, sales and conversion per product, stamped with the target day.

    A NULL product among the items keeps its own row: it matches no viewed product.
    """
    v = metrics.product_views(views, day).alias("v")
    p = metrics.product_purchases(purchases, day).alias("p")
    return v.join(p, F.col("v.product_id") == F.col("p.product_id"), "full_outer").select(
        F.coalesce("v.product_id", "p.product_id").alias("product_id"),
        "category",
        "brand",
        F.lit(day).cast("date").alias("date"),
        or_zero(F.col("total_views")).alias("total_views"),
        or_zero(F.col("total_purchases")).alias("total_purchases"),
        unit_conversion(F.col("total_purchases"), F.col("total_views")).alias("conversion_rate"),
        or_no_money(F.col("total_revenue")).alias("total_revenue"),
        or_no_money(F.col("avg_price")).alias("avg_price"),
        or_zero(F.col("unique_viewers")).alias("unique_viewers"),
        _stamp(now),
    )
