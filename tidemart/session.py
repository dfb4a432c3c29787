"""Spark session settings shared by every job."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that results depend on: day boundaries are UTC days.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings that only speed depends on.
SPEED_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streams without state are sized like batches: a hot folder's rows are split over tasks.
    "spark.sql.adaptive.streaming.stateless.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}

KAFKA_PACKAGE = "org.apache.spark:spark-sql-kafka-0-10_2.13:{version}"


def build_session(
    app_name: str,
    *,
    master: str | None = None,
    kafka: bool = False,
    shuffle_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session.

    ``shuffle_partitions`` is where adaptive execution starts before it merges small
    partitions; size it as shuffled bytes / 128 MB. ``kafka`` adds the connector package,
    which needs a reachable package repository (or the jar on the class path).
    """
    import pyspark

    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RESULT_SETTINGS, **SPEED_SETTINGS}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if kafka:
        builder = builder.config(
            "spark.jars.packages", KAFKA_PACKAGE.format(version=pyspark.__version__)
        )
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def pin_results(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session someone else built."""
    for key, value in RESULT_SETTINGS.items():
        spark.conf.set(key, value)
    return spark
