from datetime import datetime
from decimal import Decimal

import pytest

from tidemart.operators.bronze import to_bronze
from tidemart.operators.silver import accept_reject_counts, to_silver
from tidemart.schemas import SILVER_EVENT, silver_schema


def _event(kind, body):
    return f'{{"event_id":"e","event_type":"{kind}","timestamp":"2024-02-01T10:00:00Z",{body}}}'


def test_page_views(messages_of):
    sent = messages_of(
        ("k1", _event("page_view", '"user_id":"u1","metadata":{"a":2.5,"b":true,"c":null,"d":{"x":1}}')),
        ("k2", _event("page_view", '"session_id":"s"')),
        ("k3", _event("purchase", '"user_id":"u1","total_amount":1')),
        ("k4", '{"event_type":"page_view","timestamp":"bad","user_id":"u4"}'),
        ("k5", "{oops"),
        ("k6", _event("page_view", '"user_id":""')),
    )
    rows = to_silver(to_bronze(sent), "page_views").orderBy("event_id").collect()
    # The id is bronze's, and a bad time stays empty here.
    assert [(r.event_id, r.user_id) for r in rows] == [("k1", "u1"), ("k4", "u4"), ("k6", "")]
    assert rows[0].timestamp == datetime(2024, 2, 1, 10)
    assert rows[1].timestamp is None
    assert rows[0].metadata == {"a": "2.5", "b": "true", "c": None, "d": '{"x":1}'}


def test_purchases_are_permissive_per_field(messages_of):
    items = '"items":[{"product_id":"p","quantity":"x","unit_price":"9.99","total_price":19.985}]'
    sent = messages_of(
        ("k1", _event("purchase", f'"user_id":"u","total_amount":12.345,"discount_percent":"z",{items}')),
        ("k2", _event("purchase", '"user_id":"u","total_amount":123456789.12')),
        ("k3", _event("purchase", '"user_id":"u","total_amount":"9.99","items":[]')),
        ("k4", _event("purchase", '"total_amount":1')),
        ("k5", _event("purchase", '"user_id":"u"')),
    )
    rows = to_silver(to_bronze(sent), "purchases").orderBy("event_id").collect()
    assert [r.event_id for r in rows] == ["k1", "k3"]
    assert rows[0].total_amount == Decimal("12.35") and rows[0].discount_percent is None
    assert rows[0]["items"][0].asDict() == {
        "product_id": "p", "quantity": None, "unit_price": Decimal("9.99"),
        "total_price": Decimal("19.99"), "category": None, "brand": None,
    }
    assert rows[1].total_amount == Decimal("9.99") and rows[1]["items"] == []


def test_cart_needs_a_positive_quantity(messages_of):
    sent = messages_of(
        *[(f"k{q}", _event("add_to_cart", f'"user_id":"u","quantity":{q}')) for q in (-1, 0, 1, 2)],
        ("kn", _event("add_to_cart", '"user_id":"u"')),
    )
    rows = to_silver(to_bronze(sent), "cart_events").orderBy("event_id").collect()
    assert [r.quantity for r in rows] == [1, 2]


def test_updates_need_a_product_not_a_user(messages_of):
    sent = messages_of(
        ("a", _event("product_update", '"product_id":"p","update_type":"x"')),
        ("b", _event("product_update", '"user_id":"u"')),
    )
    assert [r.event_id for r in to_silver(to_bronze(sent), "product_updates").collect()] == ["a"]


@pytest.mark.parametrize("table", SILVER_EVENT)
def test_schema(messages_of, table):
    rows = to_silver(to_bronze(messages_of(("k", "{}"))), table)
    wanted = silver_schema(table)
    assert [(f.name, f.dataType.simpleString()) for f in rows.schema] == [
        (f.name, f.dataType.simpleString()) for f in wanted
    ]


@pytest.mark.parametrize("table", SILVER_EVENT)
def test_each_message_is_parsed_once(spark, messages_of, table):
    bronze = to_bronze(messages_of(("k", "{}")))
    plan = to_silver(bronze, table)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_duplicates_survive(messages_of):
    twice = [("k", _event("page_view", '"user_id":"u"'))] * 2
    assert to_silver(to_bronze(messages_of(*twice)), "page_views").count() == 2


def test_counts_add_up(messages_of):
    sent = messages_of(
        ("k", _event("page_view", '"user_id":"u"')),
        ("k", _event("page_view", '"x":1')),
        ("k", _event("add_to_cart", '"user_id":"u","quantity":0')),
        ("k", _event("add_to_cart", '"user_id":"u","quantity":"many"')),
        ("k", _event("other", '"user_id":"u"')),
        ("k", "{oops"),
    )
    got = {r.event_type: (r.received, r.accepted, r.rejected) for r in accept_reject_counts(to_bronze(sent)).collect()}
    assert got == {
        "page_view": (2, 1, 1), "add_to_cart": (2, 0, 2), "other": (1, 0, 1), "unknown": (1, 0, 1),
    }


def test_counts_match_the_tables(spark):
    from conftest import TINY

    from tidemart.sources.given import messages

    bronze = to_bronze(messages(spark, TINY))
    counted = {r.event_type: r.accepted for r in accept_reject_counts(bronze).collect()}
    for table, kind in SILVER_EVENT.items():
        assert to_silver(bronze, table).count() == counted[kind]
