"""The registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from tidemart.queries import gold, jobs, lake, messages, silver
from tidemart.queries.common import Query

QUERIES: dict[str, Query] = {
    **gold.QUERIES,
    **messages.QUERIES,
    **silver.QUERIES,
    **lake.QUERIES,
    **jobs.QUERIES,
}
