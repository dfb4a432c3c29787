import os
import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import functions as F  # noqa: E402

from tidemart.schemas import ENVELOPE  # noqa: E402
from tidemart.session import build_session  # noqa: E402
from tidemart.sources.lake import Lake  # noqa: E402

TINY = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ARRIVAL = datetime(2024, 3, 1, 12, 0, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        shuffle_partitions=4,
        settings={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    prefix = "".join(c for c in tmp_path.name.lower() if c.isalnum()) + "_"
    return Lake(spark, str(tmp_path / "lake"), prefix).create()


@pytest.fixture
def messages_of(spark):
    """Envelope rows from (key, value) pairs; offsets count up from 100."""

    def build(*pairs, topic="page-views"):
        rows = [
            (
                None if key is None else bytearray(key.encode()),
                None if value is None else bytearray(value.encode()),
                topic,
                i % 3,
                100 + i,
                ARRIVAL,
                0,
            )
            for i, (key, value) in enumerate(pairs)
        ]
        return spark.createDataFrame(rows, ENVELOPE)

    return build


@pytest.fixture
def silver_inputs(spark):
    """Views and purchases from short tuples."""
    item = "struct<product_id:string,quantity:int,unit_price:decimal(10,2),total_price:decimal(10,2),category:string,brand:string>"

    def views(*rows):
        schema = "timestamp string, user_id string, session_id string, product_id string"
        made = spark.createDataFrame([r + (None,) * (4 - len(r)) for r in rows], schema)
        return made.withColumn("timestamp", F.col("timestamp").cast("timestamp"))

    def purchases(*rows):
        schema = f"timestamp string, user_id string, total_amount string, payment_method string, items array<{item}>"
        made = spark.createDataFrame([r + (None,) * (5 - len(r)) for r in rows], schema)
        return made.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withColumn(
            "total_amount", F.col("total_amount").cast("decimal(10,2)")
        )

    return views, purchases
