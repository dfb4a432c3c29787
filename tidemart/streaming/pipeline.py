"""Messages -> bronze -> five silver tables, as Structured Streaming queries.

All queries are stateless and append only; each has its own checkpoint. The silver queries follow the manifest of the raw
events, and silver's own manifests say how far each table has got, so rows are neither lost nor repeated by a
batch that runs again, whatever it had written before.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemart.operators.bronze import to_bronze
from tidemart.operators.silver import to_silver
from tidemart.schemas import SILVER_EVENT
from tidemart.sources.lake import Lake

log = logging.getLogger(__name__)

JOB_TYPES = ("ingestion", "processing", "both")

# How often each job looks for new rows.
INGEST_EVERY = {"processingTime": "30 seconds"}
REFINE_EVERY = {"processingTime": "1 minute"}
DRAIN = {"availableNow": True}

WATCH_SECONDS = 10

# The tables that streams write.
TABLES = [("bronze", "raw_events"), *(("silver", table) for table in SILVER_EVENT)]


def ingest(
    lake: Lake, messages: DataFrame, *, trigger: dict = INGEST_EVERY, id_order: str = "key_first"
) -> StreamingQuery:
    """Job 1: keep every message as a raw event."""
    rows = to_bronze(messages, id_order=id_order)
    return lake.append_stream(rows, "bronze", "raw_events", job="bronze", trigger=trigger)


def _take(lake: Lake, table: str, newest: int) -> None:
    """Bring one silver table up to an entry of the raw events. What it has taken already it does not take again."""
    while True:
        after = lake.manifest("silver", table).state().upto
        if after is not None and newest <= after:
            return
        parts, upto = lake.added("bronze", "raw_events", after, newest, SILVER_EVENT[table])
        if not parts:
            return
        rows = to_silver(lake.rows_of("bronze", "raw_events", parts), table)
        if lake.append_followed(rows, "silver", table, after=after, upto=upto):
            return  # else someone else has brought it further meanwhile


def refine(
    lake: Lake, table: str, *, trigger: dict = REFINE_EVERY, files: int | None = None
) -> StreamingQuery:
    """Job 2, for one silver table. Reads only the raw events of its type; ``files`` bounds the commits of a batch."""
    return lake.follow(
        "bronze", "raw_events", lambda newest: _take(lake, table, newest),
        job=f"silver_{table}", trigger=trigger, value=SILVER_EVENT[table], commits=files,
    )


def refine_all(lake: Lake, *, trigger: dict = REFINE_EVERY, files: int | None = None) -> StreamingQuery:
    """Job 2 for all silver tables in one query: each batch reads each raw event once, and writes five tables side by side.

    Every table knows how far it has got. A batch that stops after some of them is run again for the others only.
    """

    def take(newest: int) -> None:
        with ThreadPoolExecutor(len(SILVER_EVENT)) as pool:
            for done in [pool.submit(_take, lake, table, newest) for table in SILVER_EVENT]:
                done.result()

    return lake.follow("bronze", "raw_events", take, job="silver", trigger=trigger, commits=files)


def start(
    lake: Lake,
    job_type: str = "both",
    messages: DataFrame | None = None,
    *,
    trigger: dict | None = None,
    id_order: str = "key_first",
    files: int | None = None,
    single: bool = False,
) -> list[StreamingQuery]:
    """Start 1 (``ingestion``), 5 (``processing``) or 6 (``both``) queries.

    ``single`` makes one query of the five. ``files`` bounds the bronze commits a silver batch takes, so that a long
    backlog is worked off in steps. If a query fails to start, those already running are stopped.
    """
    if job_type not in JOB_TYPES:
        raise ValueError(f"job type must be one of {JOB_TYPES}, not {job_type!r}")
    if job_type != "processing" and messages is None:
        raise ValueError("ingestion needs a message stream")
    running: list[StreamingQuery] = []
    try:
        if job_type != "processing":
            running.append(
                ingest(lake, messages, trigger=trigger or INGEST_EVERY, id_order=id_order)
            )
        if job_type != "ingestion" and single:
            running.append(refine_all(lake, trigger=trigger or REFINE_EVERY, files=files))
        elif job_type != "ingestion":
            for table in SILVER_EVENT:
                running.append(refine(lake, table, trigger=trigger or REFINE_EVERY, files=files))
    except Exception:
        stop(running)
        raise
    log.info("started %d streaming queries", len(running))
    return running


def stop(queries: list[StreamingQuery]) -> None:
    for query in queries:
        query.stop()


def run_until_stopped(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Block until any of the queries ends; stop the rest, and raise if it ended by an error.

    Waiting on all at once means a failure of any query is noticed, not only of the first.
    """
    try:
        while all(query.isActive for query in queries):
            # Queries that ended before, ours or not, would end the waiting at once.
            spark.streams.resetTerminated()
            spark.streams.awaitAnyTermination(WATCH_SECONDS)
    finally:
        stop(queries)
    for query in queries:
        if query.exception():
            raise query.exception()


def drain(
    lake: Lake, messages: DataFrame | None = None, job_type: str = "both", **choices
) -> None:
    """Process everything that is there now, layer after layer, then return."""
    if job_type != "processing":
        for query in start(lake, "ingestion", messages, trigger=DRAIN, **choices):
            query.awaitTermination()
    if job_type != "ingestion":
        queries = start(lake, "processing", trigger=DRAIN, **choices)
        try:
            for query in queries:
                query.awaitTermination()
        finally:
            stop(queries)
