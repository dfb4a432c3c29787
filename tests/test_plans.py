"""What the plans must look like, whatever the size of the data."""

import pytest
from conftest import TINY

import __spark_entry__ as driver
from tidemart.operators import metrics
from tidemart.operators.bronze import to_bronze
from tidemart.operators.silver import to_silver
from tidemart.plans import gold
from tidemart.plans.generator import Shop, numbered
from tidemart.queries import QUERIES
from tidemart.queries.common import messages
from tidemart.sources.given import page_views, purchases, purchases_by_line

# These write tables or run streams while they are built; their reads are covered by the rest.
RUNS_JOBS = ("stream_", "run_log_", "gold_overwrite", "bronze_stream", "layer_", "silver_table", "table_schemas")


def _plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if not n.startswith(RUNS_JOBS)])
def test_no_pairwise_joins_no_python_no_single_task(spark, name):
    plan = _plan(driver.queries()[name](spark, TINY))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "CollectLimit", "collect_list", "collect_set"):
        assert bad not in plan
    # One task for all is only right for whole-table totals.
    if "Exchange SinglePartition" in plan:
        assert name.endswith(("_totals", "_checks", "_through_silver")) or name == "event_rate"


@pytest.mark.parametrize(
    "build",
    [
        lambda v, p, lines: gold.daily_customer_analytics(v, p, "2024-01-10"),
        lambda v, p, lines: gold.daily_sales_summary(v, p, "2024-01-10"),
        lambda v, p, lines: gold.product_performance_analytics(v, lines, "2024-01-10"),
    ],
)
def test_day_bound_reaches_both_scans(spark, build):
    inputs = page_views(spark, TINY), purchases(spark, TINY), purchases_by_line(spark, TINY)
    plan = build(*inputs)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert plan.count("GreaterThanOrEqual(ts,2024-01-10T00:00)") == 2


def test_silver_has_no_shuffle(spark):
    for table in ("page_views", "purchases"):
        assert "Exchange" not in _plan(to_silver(to_bronze(messages(spark, TINY)), table))


def test_generator_has_no_shuffle_and_no_join(spark):
    plan = _plan(Shop().messages(numbered(spark, 10)))
    assert "Exchange" not in plan and "Join" not in plan


def test_products_join_without_another_shuffle(spark, silver_inputs):
    """Both sides come out of their grouping partitioned by product already."""
    views, bought = silver_inputs
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        v = views(("2024-01-10 00:00:00", "u", "s", "p"))
        p = bought(("2024-01-10 00:00:00", "u", "1.00", "m", []))
        sides = metrics.product_views(v, "2024-01-01"), metrics.product_purchases(p, "2024-01-01")
        alone = sum(_plan(side).count("Exchange hashpartitioning") for side in sides)
        joined = gold.product_performance_analytics(v, p, "2024-01-01")
        assert _plan(joined).count("Exchange hashpartitioning") == alone
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_distincts_copy_each_row_twice(spark):
    plan = _plan(metrics.page_view_metrics(page_views(spark, TINY), "2024-01-01"))
    expand = next(line for line in plan.splitlines() if "Expand [" in line)
    assert expand.split("], [").__len__() - 1 == 2


def test_category_and_brand_are_hashed_first(spark):
    plan = _plan(metrics.product_purchases(purchases_by_line(spark, TINY), "2024-01-01"))
    bottom = plan.split("Generate inline")[0].splitlines()[-3:]
    assert any("HashAggregate" in line and "partial_sum" in line for line in bottom)


def test_only_needed_columns_are_read(spark, lake):
    rows = metrics.traffic_metrics(lake.read("silver", "page_views", "2024-01-10"), "2024-01-10")
    schema = _plan(rows).split("ReadSchema: struct<")[1].split(">")[0]
    # An empty table has no folders yet to take event_date from.
    read = {c.split(":")[0] for c in schema.split(",")} - {"event_date"}
    assert read == {"session_id", "timestamp", "user_id"}
