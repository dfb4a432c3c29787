"""Money, rates and segments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def or_no_money(value: Column) -> Column:
    return F.coalesce(value, F.expr("0.0"))


def mean_money(total: Column, entries: Column) -> Column:
    """Average of DECIMAL(10,2) values from their sum and count, as DECIMAL(14,6).

    Equals ``avg`` digit for digit: the quotient carries 18 digits before it is rounded to
    six, so rounding twice could only differ beyond 10^12 entries in one group.
    """
    quotient = total.cast("decimal(20,2)") / entries.cast("decimal(15,0)")
    return F.when(entries > 0, quotient.cast("decimal(14,6)"))


def unit_conversion(units: Column, views: Column) -> Column:
    """Units bought per view as DECIMAL(21,11); 0 without views, NULL without purchases.

    Operands have one width for all sizes. The quotient carries 18 digits before it is rounded
    to eleven; a ratio of 10^10 or more does not fit and is an error, never a silent NULL.
    """
    ratio = units.cast("decimal(20,0)") / views.cast("decimal(20,0)")
    return F.when(views > 0, ratio.cast("decimal(21,11)")).otherwise(F.expr("0.0"))


def per_visitor(amount: Column, visitors: Column) -> Column:
    """``amount`` per visitor as double; 0 without visitors, NULL without an amount."""
    return F.when(
        visitors > 0, amount.cast("double") / visitors.cast("double")
    ).otherwise(F.lit(0.0))


def customer_segment(purchases: Column, revenue: Column, page_views: Column) -> Column:
    """Buyers are ranked by revenue, everyone else by page views."""
    # Tier names and thresholds.
    buyer = (
        F.when(revenue >= 1000, "high_value")
        .when(revenue >= 100, "medium_value")
        .otherwise("low_value")
    )
    visitor = F.when(page_views > 10, "engaged_browser").when(page_views > 0, "casual_browser")
    return F.when(purchases > 0, buyer).otherwise(F.coalesce(visitor, F.lit("unknown")))


def since(moment: Column, day) -> Column:
    """``moment`` falls on ``day`` or later; open-ended, and pushed down to the scan."""
    return F.to_date(moment) >= F.lit(day).cast("date")
