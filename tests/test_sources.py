import pytest
from pyspark.errors import AnalysisException

from tidemart import reporting
from tidemart.__main__ import main, parse
from tidemart.operators.messages import ALL_TOPICS
from tidemart.schemas import ENVELOPE
from tidemart.sources import messages
from tidemart.sources.lake import Lake


def test_kafka_options():
    options = messages.kafka_options("host:9092", maxOffsetsPerTrigger="1000")
    assert options == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "raw-events,page-views,order-events,purchases,user-sessions,product-updates",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "1000",
    }
    assert len(ALL_TOPICS) == 6


def test_kafka_without_the_connector(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        messages.from_kafka(spark, messages.kafka_options("host:9092"))


@pytest.mark.parametrize("file_format", ["parquet", "json"])
def test_files(spark, messages_of, tmp_path, file_format):
    sent = messages_of(("k", '{"a":1}'), (None, "é"), ("x", None))
    folder = str(tmp_path / "m")
    messages.to_files(sent, folder, file_format)
    got = messages.from_files(spark, folder, stream=False, file_format=file_format)
    assert [f.dataType for f in got.schema] == [f.dataType for f in ENVELOPE]
    assert sorted(got.collect(), key=lambda r: r.offset) == sorted(sent.collect(), key=lambda r: r.offset)
    assert messages.from_files(spark, folder, file_format=file_format).isStreaming


def test_command_line():
    assert parse(["sales", "--date", "2024-01-02"]).target_date == "2024-01-02"
    assert parse(["customer"]).target_date == "today"
    assert parse(["product", "--target_date", "yesterday"]).target_date == "yesterday"
    stream = parse(["stream", "--landing", "x", "--job-type", "ingestion"])
    assert (stream.job_type, stream.once) == ("ingestion", False)
    made = parse(["generate", "--bootstrap-servers", "h:1", "-c"])
    assert (made.num_events, made.delay, made.continuous) == (1000, 0.1, True)
    with pytest.raises(SystemExit):
        parse(["stream"])


def test_command_line_end_to_end(spark, tmp_path):
    lake, landing = str(tmp_path / "lake"), str(tmp_path / "landing")
    main(["generate", "--num-events", "400", "--landing", landing, "--lake", lake])
    main(["stream", "--once", "--landing", landing, "--lake", lake])
    main(["stream", "--once", "--job-type", "processing", "--files-per-trigger", "1",
          "--landing", landing, "--lake", lake])
    main(["customer", "--lake", lake, "--date", "yesterday", "--show"])
    main(["product", "--lake", lake, "--date", "2999-01-01", "--show"])
    opened = Lake(spark, lake)
    assert opened.read("bronze", "raw_events").count() == 400
    assert sum(r.row_count for r in opened.inventory().collect()) == 400
    assert not opened.read("gold", "daily_customer_analytics").isEmpty()
    assert {r.status for r in opened.read("ops", "run_log").collect()} == {"SUCCESS", "SUCCESS_NO_DATA"}


def test_summary_and_inventory_never_fail(spark, lake, caplog):
    assert reporting.summarize(lake.read("silver", "purchases"), "purchases") == 0
    assert "purchases is empty" in caplog.text
    missing = Lake(spark, lake.root, "no_such_")
    reporting.log_inventory(missing)
    assert "could not list" in caplog.text
