"""The three gold jobs: read silver, build, write once, log the run."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from functools import partial

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemart import reporting
from tidemart.operators import metrics, totals
from tidemart.plans import gold
from tidemart.sources.lake import Lake

log = logging.getLogger(__name__)


def _count(value) -> str:
    return str(int(value or 0))


def _dollars(value) -> str:
    return f"${value or 0:.2f}"


def _percent(value) -> str:
    return f"{value or 0:.2%}"


@dataclass(frozen=True)
class GoldJob:
    """``evidence`` are the inputs of which at least one must have a row for there to be data."""

    table: str
    build: Callable[..., DataFrame]
    totals: Callable[[], list[Column]]
    evidence: Callable[[DataFrame, DataFrame], list[DataFrame]]
    # logged metric -> (total it shows, format)
    shown: dict[str, tuple[str, Callable]]


JOBS = {
    "customer": GoldJob(
        "daily_customer_analytics",
        # By user and day: over several days the user-only join would count sums once per pair.
        partial(gold.daily_customer_analytics, same_day=True),
        totals.customer_totals,
        lambda views, purchases: [views, purchases],
        {
            "total_customers_processed": ("total_customers", _count),
            "high_value_customers": ("high_value_customers", _count),
            "total_revenue_processed": ("total_revenue", _dollars),
        },
    ),
    "sales": GoldJob(
        "daily_sales_summary",
        gold.daily_sales_summary,
        totals.sales_totals,
        lambda views, purchases: [views, purchases],
        {
            "total_days_processed": ("total_days", _count),
            "total_orders": ("total_orders", _count),
            "total_revenue": ("total_revenue", _dollars),
            "avg_order_value": ("avg_order_value", _dollars),
            "unique_customers": ("unique_customers", _count),
            "avg_conversion_rate": ("avg_conversion_rate", _percent),
        },
    ),
    "product": GoldJob(
        "product_performance_analytics",
        gold.product_performance_analytics,
        totals.product_totals,
        lambda views, purchases: [
            views.where(F.col("product_id").isNotNull()),
            metrics.purchased_items(purchases),
        ],
        {
            "total_products": ("total_products", _count),
            "total_purchases": ("total_purchases", _count),
            "total_revenue": ("total_revenue", _dollars),
            "avg_conversion_rate": ("avg_conversion_rate", _percent),
        },
    ),
}


def target_day(text: str | None = None) -> date:
    """``YYYY-MM-DD``, ``today`` (the default) or ``yesterday``, as UTC days."""
    today = datetime.now(timezone.utc).date()
    if text in (None, "today"):
        return today
    if text == "yesterday":
        return today - timedelta(days=1)
    return date.fromisoformat(text)


def run(
    lake: Lake, job: str, day: str | date | None = None, *, mode: str = "replace", **build_options
) -> dict:
    """Run one gold job for ``day`` and later; returns the logged record.

    One pass over silver: totals are gathered while the table is written. Whether there is
    anything to do is asked of the filtered inputs, which stops at the first row, rather than
    of the joined result, which would compute it twice. Without data the old table stays.
    """
    plan = JOBS[job]
    day = day if isinstance(day, date) else target_day(day)
    name = lake.name("gold", plan.table)
    try:
        reporting.log_inventory(lake)
        views = lake.read("silver", "page_views", day)
        purchases = lake.read("silver", "purchases", day)
        if all(rows.isEmpty() for rows in plan.evidence(views, purchases)):
            log.warning("no data for %s since %s", name, day)
            return reporting.record(lake, day, reporting.NO_DATA, table=name)
        seen = Observation(f"{plan.table}-{day}")
        rows = plan.build(views, purchases, day, **build_options)
        lake.overwrite_gold(rows, plan.table, mode, (seen, plan.totals()))
        found = seen.get
        shown = {metric: show(found[total]) for metric, (total, show) in plan.shown.items()}
        return reporting.record(lake, day, reporting.SUCCESS, table=name, metrics=shown)
    except Exception as error:
        reporting.record(lake, day, reporting.FAILED, table=name, error=error)
        raise
