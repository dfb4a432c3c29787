from datetime import datetime

from conftest import ARRIVAL
from pyspark.sql import functions as F

from tidemart.operators.bronze import offset_ranges, route, to_bronze
from tidemart.operators.messages import event_rate, key_for, topic_for
from tidemart.schemas import RAW_EVENTS


def test_identity_type_and_time(messages_of):
    sent = messages_of(
        ("u1", '{"event_id":"e1","event_type":"page_view","timestamp":"2024-02-01T10:00:00.123456Z"}'),
        (None, '{"event_id":"e2","event_type":"purchase","timestamp":"nope"}'),
        (None, '{"event_type":"mystery"}'),
        (None, "{oops"),
        ("", '{"event_id":"e5"}'),
        (None, None),
        ("u7", "[]"),
        (None, '{"event_id":"first","event_id":"second","event_type":null}'),
    )
    rows = to_bronze(sent).orderBy("offset").collect()
    assert [r.event_id for r in rows] == [
        "u1", "e2", "kafka_102", "kafka_103", "", "kafka_105", "u7", "first",
    ]
    assert [r.event_type for r in rows] == [
        "page_view", "purchase", "mystery", "unknown", "unknown", "unknown", "unknown", "unknown",
    ]
    assert rows[0].timestamp == datetime(2024, 2, 1, 10, 0, 0, 123456)
    assert {r.timestamp for r in rows[1:]} == {ARRIVAL}
    assert rows[3].raw_data == "{oops" and rows[5].raw_data is None


def test_payload_first_identity(messages_of):
    sent = messages_of(("u1", '{"event_id":"e1"}'), ("u2", "{}"), (None, "{}"))
    rows = to_bronze(sent, id_order="payload_first").orderBy("offset").collect()
    assert [r.event_id for r in rows] == ["e1", "u2", "kafka_102"]


def test_schema_and_given_time(messages_of):
    now = F.lit("2024-05-05 05:05:05").cast("timestamp")
    rows = to_bronze(messages_of(("k", "{}")), now=now)
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in RAW_EVENTS]
    assert rows.first().processing_time == datetime(2024, 5, 5, 5, 5, 5)


def test_route_has_a_bounded_number_of_values(messages_of):
    sent = messages_of(*[("k", f'{{"event_type":"kind-{i}"}}') for i in range(20)], ("k", '{"event_type":"purchase"}'))
    routes = {r.r for r in to_bronze(sent).select(route().alias("r")).collect()}
    assert routes == {"other", "purchase"}


def test_offset_ranges(messages_of):
    sent = messages_of(*[("k", "{}")] * 7)
    rows = {r.partition: (r.first_offset, r.last_offset, r.messages) for r in offset_ranges(to_bronze(sent)).collect()}
    assert rows == {0: (100, 106, 3), 1: (101, 104, 2), 2: (102, 105, 2)}


def test_topic_and_key(spark):
    rows = spark.createDataFrame(
        [("purchase", "u", "p"), ("other", "", "p"), (None, None, None), ("page_view", None, "p")],
        "kind string, u string, p string",
    )
    got = rows.select(topic_for(F.col("kind")), key_for(F.col("u"), F.col("p"))).collect()
    assert [tuple(r) for r in got] == [
        ("purchases", "u"), ("raw-events", "p"), ("raw-events", "unknown"), ("page-views", "p"),
    ]
    assert rows.select(topic_for(F.col("kind"), "mine").alias("t")).collect()[1].t == "mine"


def test_rate_over_no_time_is_zero(messages_of):
    assert event_rate(messages_of(("k", "{}"), ("k", "{}"))).first().events_per_minute == 0.0
