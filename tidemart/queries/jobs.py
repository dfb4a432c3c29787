"""The gold jobs' run log, on a lake filled from the message stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemart.plans import jobs
from tidemart.queries.common import FIRST_DAY, MESSAGES_SQL, Query
from tidemart.queries.lake import drained
from tidemart.sources.lake import Lake
from tidemart.workspace import fresh_folder

_WITH = "WITH " + MESSAGES_SQL
NO_DATA_DAY = "2031-05-05"


class _OwnResults(Lake):
    """A filled lake's bronze and silver, with gold and the run log in a place of their own."""

    def __init__(self, filled: Lake):
        prefix = f"t{uuid.uuid4().hex[:10]}_"
        super().__init__(filled.spark, fresh_folder(filled.spark, "gold"), prefix)
        self._filled = filled
        self.create()

    def read(self, layer, table, day=None):
        if layer in ("bronze", "silver"):
            return self._filled.read(layer, table, day)
        return super().read(layer, table, day)


def _log(lake: Lake):
    metric = lambda name: F.try_element_at("metrics", F.lit(name)).alias(name)
    return lake.read("ops", "run_log").select(
        "processing_date",
        "status",
        "data_version",
        F.substring_index("table_location", ".", -1).alias("gold_table"),
        metric("total_customers_processed"),
        metric("high_value_customers"),
        metric("total_revenue_processed"),
        metric("total_days_processed"),
        metric("total_orders"),
        metric("total_revenue"),
        metric("unique_customers"),
        metric("total_products"),
        metric("total_purchases"),
        "error_type",
        "error_message",
    )


def _success(spark, folder):
    lake = _OwnResults(drained(spark, folder))
    for job in jobs.JOBS:
        jobs.run(lake, job, FIRST_DAY)
    return _log(lake)


def _no_data(spark, folder):
    """A run that finds data, then one that finds none: the table written first must stay."""
    lake = _OwnResults(drained(spark, folder))
    jobs.run(lake, "sales", FIRST_DAY)
    jobs.run(lake, "sales", NO_DATA_DAY)
    days = lake.read("gold", "daily_sales_summary").count()
    log = lake.read("ops", "run_log").where(F.col("processing_date") == NO_DATA_DAY)
    return log.select("processing_date", "status", "data_version", F.lit(days).alias("days_kept"))


def _failed(spark, folder):
    lake = _OwnResults(drained(spark, folder))
    jobs.run(lake, "sales", FIRST_DAY)
    try:
        jobs.run(lake, "sales", FIRST_DAY, mode="no such mode")
    except ValueError:
        pass
    return lake.read("ops", "run_log").select("processing_date", "status", "data_version", "error_type")


_SIDES_SQL = f"""{_WITH},
v AS (SELECT CAST(payload_time AS DATE) AS d, payload_user AS u, payload_product AS p
      FROM accepted WHERE event_type = 'page_view' AND payload_time IS NOT NULL),
b AS (SELECT CAST(payload_time AS DATE) AS d, payload_user AS u, amount, n, k
      FROM accepted WHERE event_type = 'purchase' AND payload_time IS NOT NULL),
i AS (SELECT IF(i = 1, k, CONCAT(k, '-', CAST(i AS VARCHAR))) AS p, i AS units, amount * i AS paid
      FROM (SELECT *, unnest(range(1, n % 4 + 1)) AS i FROM b WHERE n % 29 <> 0))"""

_SUCCESS_SQL = f"""{_SIDES_SQL},
c AS (SELECT x.u AS xu, COALESCE(y.revenue, 0) AS revenue
      FROM (SELECT DISTINCT u, d FROM v) x
      FULL JOIN (SELECT u, d, sum(amount) AS revenue FROM b GROUP BY u, d) y ON x.u = y.u AND x.d = y.d),
logged AS (
  SELECT 'daily_customer_analytics' AS gold_table,
         CAST((SELECT count(*) FROM c) AS VARCHAR) AS total_customers_processed,
         CAST((SELECT count(*) FROM c WHERE revenue >= 1000) AS VARCHAR) AS high_value_customers,
         CONCAT('$', CAST((SELECT CAST(sum(revenue) AS DECIMAL(20,2)) FROM c) AS VARCHAR)) AS total_revenue_processed,
         NULL AS total_days_processed, NULL AS total_orders, NULL AS total_revenue, NULL AS unique_customers,
         NULL AS total_products, NULL AS total_purchases
  UNION ALL SELECT 'daily_sales_summary', NULL, NULL, NULL,
         CAST((SELECT count(*) FROM (SELECT d FROM v UNION SELECT d FROM b)) AS VARCHAR),
         CAST((SELECT count(*) FROM b) AS VARCHAR),
         CONCAT('$', CAST((SELECT CAST(sum(amount) AS DECIMAL(20,2)) FROM b) AS VARCHAR)),
         CAST((SELECT sum(n) FROM (SELECT count(DISTINCT u) AS n FROM b GROUP BY d)) AS VARCHAR), NULL, NULL
  UNION ALL SELECT 'product_performance_analytics', NULL, NULL, NULL, NULL, NULL,
         CONCAT('$', CAST((SELECT CAST(sum(paid) AS DECIMAL(20,2)) FROM i) AS VARCHAR)), NULL,
         CAST((SELECT count(*) FROM (SELECT p FROM v WHERE p IS NOT NULL UNION SELECT p FROM i)) AS VARCHAR),
         CAST((SELECT CAST(sum(units) AS BIGINT) FROM i) AS VARCHAR))
SELECT DATE '{FIRST_DAY}' AS processing_date, 'SUCCESS' AS status, '{FIRST_DAY}-v1' AS data_version,
       logged.*, CAST(NULL AS VARCHAR) AS error_type, CAST(NULL AS VARCHAR) AS error_message
FROM logged"""

_DAYS_SQL = f"{_SIDES_SQL}, days AS (SELECT count(*) AS n FROM (SELECT d FROM v UNION SELECT d FROM b))"

QUERIES = {
    "run_log_success": Query(_success, _SUCCESS_SQL),
    "run_log_no_data": Query(
        _no_data,
        f"""{_DAYS_SQL} SELECT DATE '{NO_DATA_DAY}' AS processing_date,
        'SUCCESS_NO_DATA' AS status, '{NO_DATA_DAY}-v1' AS data_version, n AS days_kept FROM days""",
    ),
    "run_log_failed": Query(
        _failed,
        f"""{_DAYS_SQL} SELECT DATE '{FIRST_DAY}' AS processing_date, 'SUCCESS' AS status,
        '{FIRST_DAY}-v1' AS data_version, CAST(NULL AS VARCHAR) AS error_type
        FROM days WHERE n > 0
        UNION ALL SELECT DATE '{FIRST_DAY}', 'FAILED', '{FIRST_DAY}-error', 'ValueError'
        FROM days WHERE n > 0""",
    ),
}
