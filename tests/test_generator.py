import json

import generator_rules as rules
import pytest
from conftest import TINY
from pyspark.sql import functions as F

from tidemart.operators.bronze import to_bronze
from tidemart.operators.messages import topic_distribution
from tidemart.operators.silver import to_silver
from tidemart.plans import generator as g

START = "2024-02-01 00:00:00"


@pytest.fixture(scope="module")
def numbers(spark):
    return g.numbered(spark, 4000, F.lit(START).cast("timestamp"))


def _numbers(spark, count):
    return spark.range(count).withColumnRenamed("id", "number")


def test_catalog(spark):
    shop = g.Shop()
    rows = shop.catalog(_numbers(spark, shop.product_count)).collect()
    kinds = {}
    for r in rows:
        kinds.setdefault((r.category, r.name.rsplit(" ", 1)[0]), []).append(r)
    assert len(kinds) == 25 and {c for c, _ in kinds} == set(g.ITEM_TYPES)
    assert all(5 <= len(v) <= 15 for v in kinds.values())
    assert len({r.product_id for r in rows}) == len(rows)
    assert all(10 <= r.price <= 2000 and 1 <= r.rating <= 5 for r in rows)


def test_users(spark):
    rows = g.Shop().user_base(_numbers(spark, 1000)).collect()
    assert len({r.user_id for r in rows}) == 1000
    assert {r.user_type for r in rows} == set(g.USER_TYPES)
    assert all(1 <= len(r.preferences) <= 3 == len({*r.preferences, 1, 2, 3}) - len(set(r.preferences)) for r in rows)
    assert {len(r.preferences) for r in rows} == {1, 2, 3}


def test_same_for_any_partitioning_and_only_for_the_seed(spark, numbers):
    made = [
        sorted(bytes(r.value) for r in g.Shop(seed).messages(numbers.limit(300).repartition(n)).collect())
        for seed, n in ((1, 1), (1, 7), (2, 1))
    ]
    assert made[0] == made[1] != made[2]


def test_messages(spark, numbers):
    sent = g.Shop().messages(numbers)
    topics = {r.topic: r.messages / 4000 for r in topic_distribution(sent).collect()}
    for kind, topic in (("page_view", "page-views"), ("purchase", "purchases")):
        assert abs(topics[topic] - g.EVENT_SHARES[kind]) < 0.04
    for row in sent.limit(200).collect():
        event, key = json.loads(bytes(row.value)), bytes(row.key).decode()
        assert key == event.get("user_id", event["product_id"] if "user_id" not in event else None)
        assert (row.topic == "page-views") == (event["event_type"] == "page_view")
        if event["event_type"] == "user_session":
            assert set(event["metadata"]) == {"login_method", "session_duration", "referrer", "location"}
        if event["event_type"] == "product_update":
            assert None not in event["metadata"].values() and len(event["metadata"]) in (2, 3)


def test_every_event_reaches_silver(numbers):
    bronze = to_bronze(g.Shop().messages(numbers))
    kept = {t: to_silver(bronze, t).count() for t in ("page_views", "purchases", "cart_events", "user_sessions", "product_updates")}
    assert sum(kept.values()) == 4000 and all(kept.values())


def test_events_name_products_of_the_catalog(spark, numbers):
    shop = g.Shop()
    catalog = shop.catalog(_numbers(spark, shop.product_count)).select("product_id", "price", "brand")
    carts = shop.events(numbers, "add_to_cart").select("product_id", "price")
    assert carts.join(catalog, ["product_id", "price"], "left_anti").isEmpty()
    items = shop.events(numbers, "purchase").select(F.inline("items"))
    prices = items.select("product_id", F.col("unit_price").alias("price"), "brand")
    assert prices.join(catalog, ["product_id", "price", "brand"], "left_anti").isEmpty()


def test_weights(numbers):
    shop = g.Shop()
    quantities = shop.events(numbers, "add_to_cart").groupBy("quantity").count().collect()
    for row in quantities:
        assert abs(row["count"] / 4000 - g.CART_QUANTITIES[row.quantity]) < 0.04
    discounted = shop.events(numbers, "purchase").where("discount_percent > 0").count() / 4000
    assert abs(discounted - g.DISCOUNT_SHARE) < 0.04


def test_unending(spark, tmp_path):
    stream = g.Shop().messages(g.unending(spark, gap=0.01))
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "c"))
        .start(str(tmp_path / "m"))
    )
    try:
        for _ in range(60):
            if query.awaitTermination(1) or (query.lastProgress and query.lastProgress.numInputRows):
                break
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(str(tmp_path / "m")).count() > 0


def test_rules(spark):
    events, parts = (spark.read.parquet(f"{TINY}/{t}.parquet").count() for t in ("events", "part"))
    checked = {r.event_type: (r.events, r.broken) for r in rules.checks(spark, TINY).collect()}
    assert checked == dict.fromkeys(g.EVENT_SHARES, (events, 0))
    assert tuple(rules.catalog_checks(spark, TINY).first()) == (parts, parts, 0)
    assert tuple(rules.through_silver(spark, TINY).first()) == (events, 0)
    assert {r.event_type: r.as_expected for r in rules.mix(spark, TINY).collect()} == dict.fromkeys(g.EVENT_SHARES, 1)


@pytest.mark.parametrize(("gap", "seconds"), [(0.3, 7), (2, 9), (10, 35), (0.01, 3), (1, 5)])
def test_any_pace_is_kept(spark, gap, seconds):
    rows = spark.range(seconds).select("id", F.explode(g.paced(F.col("id"), gap)).alias("number")).collect()
    assert sorted(r.number for r in rows) == list(range(-int(-seconds / gap // 1)))
    assert all(r.id <= r.number * gap < r.id + 1 + 1e-6 for r in rows)


def test_without_pause(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(g, "BURST", 50)
    stream = g.unending(spark, gap=0, first=1000)
    query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).start(str(tmp_path / "rows"))
    try:
        while not query.lastProgress or query.lastProgress.batchId < 2:
            query.awaitTermination(1)
    finally:
        query.stop()
    numbers = sorted(r.number for r in spark.read.parquet(str(tmp_path / "rows")).select("number").collect())
    assert len(numbers) >= 100 and numbers == list(range(1000, 1000 + len(numbers)))
    with pytest.raises(ValueError, match="negative"):
        g.unending(spark, gap=-1)


def test_first_number(spark):
    assert [r.number for r in g.numbered(spark, 3, first=7).collect()] == [7, 8, 9]
