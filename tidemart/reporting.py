"""The run log - one row per gold run - and what jobs print about tables."""

from __future__ import annotations

import logging
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame

from tidemart.schemas import RUN_LOG
from tidemart.sources.lake import Lake

log = logging.getLogger(__name__)

SUCCESS, NO_DATA, FAILED = "SUCCESS", "SUCCESS_NO_DATA", "FAILED"


def record(
    lake: Lake,
    day: date,
    status: str,
    *,
    table: str | None = None,
    metrics: dict[str, str] | None = None,
    error: BaseException | None = None,
) -> dict:
    """Append a run to the log and return it.

    Runs without data and failed runs carry no application details; failed ones carry the
    error, and a version that cannot be taken for a good one.
    """
    context = lake.spark.sparkContext
    ran = status == SUCCESS
    row = {
        "processing_date": day,
        "status": status,
        "data_version": f"{day.isoformat()}-{'error' if status == FAILED else 'v1'}",
        "processing_timestamp": datetime.now(timezone.utc),
        "spark_app_name": context.appName if ran else None,
        "spark_app_id": context.applicationId if ran else None,
        "table_format": "parquet" if ran else None,
        "table_location": table,
        "metrics": metrics,
        "error_type": type(error).__name__ if error else None,
        "error_message": str(error) if error else None,
    }
    lake.append_entry(tuple(row[name] for name in RUN_LOG.names), "run_log")
    return row


def log_inventory(lake: Lake) -> None:
    """Log the databases and the silver tables there are. Not being able to is no error."""
    try:
        databases = lake.spark.sql("SHOW DATABASES").collect()
        log.info("databases: %s", [row.namespace for row in databases])
        log.info("silver tables: %s", lake.tables("silver"))
    except Exception as error:
        log.warning("could not list the catalog: %s", error)


def summarize(rows: DataFrame, label: str, sample: int = 5) -> int:
    """Log the row count and print a few rows; warn if there are none."""
    count = rows.count()
    if count:
        log.info("%s: %d rows", label, count)
        rows.show(sample, truncate=False)
    else:
        log.warning("%s is empty", label)
    return count
