"""Where tables, checkpoints and message files are written when the caller names no folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder, as named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests) may go without one; it then gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _LOCAL_ROOTS.setdefault(
        context.applicationId, tempfile.mkdtemp(prefix="tidemart-")
    )


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A folder name under the shared root that no other run uses."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
