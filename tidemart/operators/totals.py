"""Whole-table totals a gold run reports.

Each is a list of aggregate columns, so a job can gather them while it writes the table
(``DataFrame.observe``) and a query can compute them with a plain ``agg``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.measures import customer_segment, or_no_money
from tidemart.operators import metrics


def customer_totals() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("customer_segment") == "high_value").alias("high_value_customers"),
        F.sum("total_revenue").alias("total_revenue"),
    ]


def joined_on_user_totals(views: DataFrame, purchases: DataFrame, day) -> DataFrame:
    """``customer_totals`` of the customer table joined on the user alone, without its rows.

    A user with v days of views and p days of purchases has v x p rows there, or v + p if one of them is none. A buyer's segment
    hangs on the purchases' day alone, so counts and sums of each side, one row a user, say it all.
    """
    seen = metrics.page_view_metrics(views, day).groupBy("user_id").agg(F.count("*").alias("seen"))
    high = customer_segment(F.col("total_purchases"), F.col("total_revenue"), F.lit(0)) == "high_value"
    bought = metrics.purchase_metrics(purchases, day).groupBy("user_id").agg(
        F.count("*").alias("bought"), F.count_if(high).alias("high"), F.sum("total_revenue").alias("revenue")
    )
    # Rows without a user join nothing; each side keeps its own.
    users = seen.alias("s").join(bought.alias("b"), F.col("s.user_id") == F.col("b.user_id"), "full_outer")
    views_each, bought_each = F.coalesce("seen", F.lit(1)), F.coalesce("bought", F.lit(1))
    return users.agg(
        F.coalesce(F.sum(views_each * bought_each), F.lit(0)).alias("total_customers"),
        F.coalesce(F.sum(F.coalesce("high", F.lit(0)) * views_each), F.lit(0)).alias("high_value_customers"),
        F.sum(or_no_money(F.col("revenue")).cast("decimal(20,2)") * views_each).cast("decimal(30,2)").alias("total_revenue"),
    )


def sales_totals() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_days"),
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_revenue").alias("total_revenue"),
        F.avg("avg_order_value").alias("avg_order_value"),
        F.sum("unique_customers").alias("unique_customers"),
        F.avg("conversion_rate").alias("avg_conversion_rate"),
    ]


def product_totals() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_products"),
        F.sum("total_purchases").alias("total_purchases"),
        F.sum("total_revenue").alias("total_revenue"),
        F.avg("conversion_rate").alias("avg_conversion_rate"),
    ]
