from datetime import date, datetime, timedelta, timezone

import pytest
from conftest import TINY
from pyspark.sql import functions as F

from tidemart.operators.bronze import to_bronze
from tidemart.operators.silver import to_silver
from tidemart.plans import jobs
from tidemart.sources import given
from tidemart.sources.lake import Lake


class PlainSilver(Lake):
    """A lake whose silver is computed on the spot instead of by the streams."""

    def read(self, layer, table, day=None):
        if layer != "silver":
            return super().read(layer, table, day)
        rows = to_silver(to_bronze(given.messages(self.spark, TINY)), table)
        return rows if day is None else rows.where(F.to_date("timestamp") >= F.lit(day))


@pytest.fixture
def plain(spark, lake):
    return PlainSilver(spark, lake.root, lake.prefix)


def _log(lake):
    return lake.read("ops", "run_log").orderBy("processing_timestamp").collect()


def test_success(plain):
    for job, plan in jobs.JOBS.items():
        record = jobs.run(plain, job, "2024-01-05")
        written = plain.read("gold", plan.table)
        assert written.count() == int(next(iter(record["metrics"].values())))
    rows = _log(plain)
    assert [r.status for r in rows] == ["SUCCESS"] * 3
    assert {r.data_version for r in rows} == {"2024-01-05-v1"}
    assert {r.processing_date for r in rows} == {date(2024, 1, 5)}
    assert rows[0].spark_app_name == "tests" and rows[0].table_location.endswith("daily_customer_analytics")
    assert rows[0].metrics["total_revenue_processed"].startswith("$")
    assert rows[1].metrics["avg_conversion_rate"].endswith("%")
    assert int(rows[1].metrics["total_days_processed"]) == 26


def test_one_day_totals(plain):
    record = jobs.run(plain, "customer", "2024-01-30")
    written = plain.read("gold", "daily_customer_analytics")
    assert record["metrics"]["total_revenue_processed"] == f"${written.agg(F.sum('total_revenue')).first()[0]:.2f}"
    assert int(record["metrics"]["high_value_customers"]) == written.where("customer_segment = 'high_value'").count()


def test_no_data_keeps_the_table(plain):
    jobs.run(plain, "sales", "2024-01-20")
    before = plain.read("gold", "daily_sales_summary").count()
    record = jobs.run(plain, "sales", "2030-01-01")
    assert record["status"] == "SUCCESS_NO_DATA" and record["metrics"] is None
    assert plain.read("gold", "daily_sales_summary").count() == before == 11
    assert [r.status for r in _log(plain)] == ["SUCCESS", "SUCCESS_NO_DATA"]


def test_failure_is_logged_and_raised(plain, monkeypatch):
    def build(views, purchases, day):
        day = F.raise_error(F.lit("no good")).cast("date").alias("date")
        return views.select(day, F.lit(1).alias("x"))

    monkeypatch.setitem(
        jobs.JOBS, "sales", jobs.GoldJob("t", build, lambda: [F.count("x")], lambda v, p: [v], {})
    )
    with pytest.raises(Exception, match="no good"):
        jobs.run(plain, "sales", "2024-01-20")
    (row,) = _log(plain)
    assert (row.status, row.data_version) == ("FAILED", "2024-01-20-error")
    assert "no good" in row.error_message and row.error_type and row.spark_app_id is None


def test_target_day():
    today = datetime.now(timezone.utc).date()
    assert jobs.target_day() == jobs.target_day("today") == today
    assert jobs.target_day("yesterday") == today - timedelta(days=1)
    assert jobs.target_day("2024-02-29") == date(2024, 2, 29)
    with pytest.raises(ValueError):
        jobs.target_day("2024-02-30'; DROP TABLE x")
