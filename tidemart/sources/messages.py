"""Message streams in the seven-column envelope: from Kafka, or from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemart.operators.messages import ALL_TOPICS
from tidemart.schemas import ENVELOPE


# How long a stream that is landed as files gathers rows for them.
LAND_EVERY = "10 seconds"


def kafka_options(
    servers: str, topics: tuple[str, ...] = ALL_TOPICS, starting: str = "latest", **extra: str
) -> dict[str, str]:
    """Reader options. ``extra`` passes e.g. ``maxOffsetsPerTrigger`` or ``minPartitions``."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        "failOnDataLoss": "false",
        **extra,
    }


def from_kafka(spark: SparkSession, options: dict[str, str], *, stream: bool = True) -> DataFrame:
    """Needs the Kafka connector (``build_session(kafka=True)``)."""
    reader = spark.readStream if stream else spark.read
    return reader.format("kafka").options(**options).load()


def to_kafka(messages: DataFrame, servers: str, checkpoint: str | None = None, **extra: str):
    """Send messages to their topics; returns the running query when they are a stream.

    ``extra`` passes writer options, e.g. ``kafka.security.protocol``.
    """
    rows, options = messages.select("key", "value", "topic"), {"kafka.bootstrap.servers": servers, **extra}
    if not rows.isStreaming:
        return rows.write.format("kafka").options(**options).save()
    writer = rows.writeStream.format("kafka").options(**options)
    return writer.option("checkpointLocation", checkpoint).start()


def from_files(
    spark: SparkSession,
    folder: str,
    *,
    stream: bool = True,
    file_format: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Envelope rows landed as files (``parquet``, or ``json`` with base64 key and value)."""
    reader = (spark.readStream if stream else spark.read).schema(ENVELOPE).format(file_format)
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(folder)


def to_files(
    messages: DataFrame, folder: str, file_format: str = "parquet", checkpoint: str | None = None
):
    """Land messages as files; returns the running query when they are a stream."""
    rows = messages.select(*ENVELOPE.names)
    if not rows.isStreaming:
        return rows.write.mode("append").format(file_format).save(folder)
    writer = rows.writeStream.format(file_format).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=LAND_EVERY).start(folder)
