"""Grouped measures over silver views and purchases.

Counting distinct values: rows are first grouped by the counted value itself (with a map-side
combine), so a key that holds a large share of all rows is spread over many tasks before its
partial results meet; per key, only one small row per task reaches the last grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.measures import mean_money, since


def _by_either(
    rows: DataFrame, keys: list[str], first: str, second: str, *measures: Column
) -> DataFrame:
    """Group by (keys, first) and by (keys, second) in one pass.

    ``by_first`` tells the two kinds of rows apart. Every input row is in both groupings, so
    totals are taken from one of them. Two copies of a row go into the shuffle's map-side
    combine; counting two distinct columns directly makes three.
    """
    key_columns = [F.col(k) for k in keys]
    sets = [[*key_columns, F.col(first)], [*key_columns, F.col(second)]]
    return rows.groupingSets(sets, *keys, first, second).agg(
        (F.grouping(second) == 1).alias("by_first"), *measures
    )


def _from_first(name: str) -> Column:
    return F.when(F.col("by_first"), F.col(name))


def _from_second(name: str) -> Column:
    return F.when(~F.col("by_first"), F.col(name))


def page_view_metrics(views: DataFrame, day) -> DataFrame:
    """Per user and day: views, sessions, products seen, first and last activity."""
    dated = views.where(since(F.col("timestamp"), day)).select(
        "user_id", F.to_date("timestamp").alias("date"), "session_id", "product_id", "timestamp"
    )
    halves = _by_either(
        dated,
        ["user_id", "date"],
        "session_id",
        "product_id",
        F.count(F.lit(1)).alias("n"),
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
    )
    return halves.groupBy("user_id", "date").agg(
        F.sum(_from_first("n")).alias("page_views"),
        F.count(_from_first("session_id")).alias("unique_sessions"),
        F.count(_from_second("product_id")).alias("unique_products_viewed"),
        F.min("first_seen").alias("first_visit_time"),
        F.max("last_seen").alias("last_activity_time"),
    )


def purchase_metrics(purchases: DataFrame, day) -> DataFrame:
    """Per user and day: purchases, revenue, average order value."""
    return (
        purchases.where(since(F.col("timestamp"), day))
        .groupBy("user_id", F.to_date("timestamp").alias("date"))
        .agg(
            F.count(F.lit(1)).alias("total_purchases"),
            F.sum("total_amount").alias("total_revenue"),
            F.avg("total_amount").alias("avg_order_value"),
        )
    )


def sales_metrics(purchases: DataFrame, day) -> DataFrame:
    """Per day: orders, revenue, average order value, customers, most used payment method.

    The most used method is picked from per-method counts (ties: smallest name). Keeping a
    value-to-count map per group, as ``mode`` does, costs a map for every (day, customer)
    once customers are counted in the same pass.
    """
    dated = purchases.where(since(F.col("timestamp"), day)).select(
        F.to_date("timestamp").alias("date"), "user_id", "payment_method", "total_amount"
    )
    halves = _by_either(
        dated,
        ["date"],
        "user_id",
        "payment_method",
        F.count(F.lit(1)).alias("orders"),
        F.sum("total_amount").alias("revenue"),
        F.count("total_amount").alias("priced"),
    )
    # One row per (day, method) and one per day for the customers' half.
    by_method = halves.groupBy("date", "by_first", "payment_method").agg(
        F.sum("orders").alias("orders"),
        F.sum("revenue").alias("revenue"),
        F.sum("priced").alias("priced"),
        F.count("user_id").alias("customers"),
    )
    ranked = F.struct((-F.col("orders")).alias("rank"), F.col("payment_method").alias("method"))
    named = ~F.col("by_first") & F.col("payment_method").isNotNull()
    return (
        by_method.groupBy("date")
        .agg(
            F.sum(_from_first("orders")).alias("total_orders"),
            F.sum(_from_first("revenue")).cast("decimal(20,2)").alias("total_revenue"),
            F.sum(_from_first("priced")).alias("priced"),
            F.sum(_from_first("customers")).alias("unique_customers"),
            F.min(F.when(named, ranked))["method"].alias("top_payment_method"),
        )
        .select(
            "date",
            "total_orders",
            "total_revenue",
            mean_money(F.col("total_revenue"), F.col("priced")).alias("avg_order_value"),
            "unique_customers",
            "top_payment_method",
        )
    )


def traffic_metrics(views: DataFrame, day) -> DataFrame:
    """Per day: page views, visitors, sessions."""
    dated = views.where(since(F.col("timestamp"), day)).select(
        F.to_date("timestamp").alias("date"), "user_id", "session_id"
    )
    halves = _by_either(dated, ["date"], "user_id", "session_id", F.count(F.lit(1)).alias("n"))
    return halves.groupBy("date").agg(
        F.sum(_from_first("n")).alias("total_page_views"),
        F.count(_from_first("user_id")).alias("unique_visitors"),
        F.count(_from_second("session_id")).alias("total_sessions"),
    )


def product_views(views: DataFrame, day) -> DataFrame:
    """Per product: views and distinct viewers."""
    return (
        views.where(since(F.col("timestamp"), day) & F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.count(F.lit(1)).alias("total_views"),
            F.countDistinct("user_id").alias("unique_viewers"),
        )
    )


def purchased_items(purchases: DataFrame, day=None, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per bought item, with the purchase's ``keep`` columns; purchases without items
    yield none."""
    if day is not None:
        purchases = purchases.where(since(F.col("timestamp"), day))
    return purchases.select(*keep, F.inline("items"))


def product_purchases(purchases: DataFrame, day) -> DataFrame:
    """Per product: category, brand, units, revenue, average price.

    ``max`` of a string can only be computed by sorting. Grouping by (product, category,
    brand) first keeps the bulk of the work hash-based; the sort sees one row per such group.
    """
    described = (
        purchased_items(purchases, day)
        .groupBy("product_id", "category", "brand")
        .agg(
            F.sum("quantity").alias("units"),
            F.sum("total_price").alias("revenue"),
            F.sum("unit_price").alias("prices"),
            F.count("unit_price").alias("priced"),
        )
    )
    return (
        described.groupBy("product_id")
        .agg(
            F.max("category").alias("category"),
            F.max("brand").alias("brand"),
            F.sum("units").alias("total_purchases"),
            F.sum("revenue").cast("decimal(20,2)").alias("total_revenue"),
            F.sum("prices").alias("prices"),
            F.sum("priced").alias("priced"),
        )
        .select(
            "product_id",
            "category",
            "brand",
            "total_purchases",
            "total_revenue",
            mean_money(F.col("prices"), F.col("priced")).alias("avg_price"),
        )
    )
