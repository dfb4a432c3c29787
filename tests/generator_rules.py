"""Rules that generated events, products and users must keep, counted on as many of them as there
are given events, parts and customers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tidemart.operators.bronze import to_bronze
from tidemart.operators.silver import accept_reject_counts
from tidemart.plans import generator as g
from tidemart.sources.given import table


def shop(spark, folder) -> g.Shop:
    """As many products as parts and as many users as customers (counts from file footers)."""
    return g.Shop(
        products=table(spark, folder, "part").count(),
        users=table(spark, folder, "customer").count(),
    )


def numbers(spark, folder):
    return table(spark, folder, "events").select(
        F.col("event_id").alias("number"), F.col("ts").alias("moment")
    )


def catalog(spark, folder):
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("number"))
    return shop(spark, folder).catalog(parts)


def mix(spark, folder):
    """Each kind's share against its weight, within five standard deviations."""
    s, given = shop(spark, folder), numbers(spark, folder)
    events = F.lit(given.count()).cast("bigint")
    kinds = given.select(s.kind(F.col("number")).alias("event_type"))
    counts = kinds.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    wanted = F.create_map(*[F.lit(x) for pair in g.EVENT_SHARES.items() for x in pair])
    share = F.try_element_at(wanted, "event_type")
    spread = F.sqrt(share * (1 - share) / events)
    return counts.select(
        "event_type",
        events.alias("events"),
        share.alias("expected_share"),
        (F.abs(F.col("n") / events - share) < 5 * spread).cast("int").alias("as_expected"),
    )


def checks(spark, folder):
    """Per kind: events, and how many break a rule of their kind."""
    s, n = shop(spark, folder), numbers(spark, folder)
    meta = lambda name: F.col(f"metadata.{name}")

    def total(field):
        zero = F.lit(0).cast("decimal(12,2)")
        return F.aggregate("items", zero, lambda t, i: (t + i[field]).cast("decimal(12,2)"))

    rules = {
        "page_view": F.col("page_type").isin(g.PAGE_TYPES)
        & F.col("referrer").isin(g.REFERRERS)
        & F.col("device_type").isin(g.DEVICES)
        & meta("page_load_time").between(0.5, 5.0)
        & meta("scroll_depth").between(10, 100)
        & meta("time_on_page").between(5, 300),
        "add_to_cart": F.col("quantity").between(1, 5)
        & F.col("price").between(10, 2000)
        & (F.col("total_value") == F.col("price") * F.col("quantity"))
        & meta("cart_size_before").between(0, 10),
        "purchase": F.size("items").between(1, 4)
        & F.forall("items", lambda i: i["quantity"].between(1, 3))
        & F.forall("items", lambda i: i["total_price"] == i["unit_price"] * i["quantity"])
        & (F.col("subtotal") == total("total_price"))
        & (F.col("discount_percent").isin([0, *g.DISCOUNTS]))
        & (F.col("total_amount") == F.col("subtotal") - F.col("discount_amount")),
        "user_session": F.when(
            F.col("session_type") == "login",
            meta("login_method").isin(g.LOGIN_METHODS) & meta("session_duration").isNull(),
        ).otherwise(meta("login_method").isNull() & meta("session_duration").between(300, 7200)),
        "product_update": F.when(
            F.col("update_type") == "price_change",
            (meta("new_price") >= 5) & (F.abs(meta("change_percent")) <= 30),
        )
        .when(
            F.col("update_type") == "inventory_update",
            (meta("new_inventory") >= 0) & meta("change").between(-50, 100),
        )
        .otherwise(meta("new_rating").between(1, 5)),
    }
    parts = [
        s.events(n, kind).agg(
            F.count(F.lit(1)).alias("events"),
            F.count_if(~F.coalesce(rule, F.lit(False))).alias("broken"),
        ).select(F.lit(kind).alias("event_type"), "*")
        for kind, rule in rules.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def catalog_checks(spark, folder):
    rows = catalog(spark, folder)
    kept = (
        F.col("price").between(10, 2000)
        & F.col("rating").between(1, 5)
        & F.col("inventory_count").between(0, 1000)
        & F.col("category").isin(list(g.ITEM_TYPES))
    )
    return rows.agg(
        F.count(F.lit(1)).alias("products"),
        F.countDistinct("product_id").alias("ids"),
        F.count_if(~kept).alias("broken"),
    )


def through_silver(spark, folder):
    """Generated messages, taken through bronze: every one must pass silver's rules."""
    sent = shop(spark, folder).messages(numbers(spark, folder))
    return accept_reject_counts(to_bronze(sent)).agg(
        F.sum("received").alias("received"), F.sum("rejected").alias("rejected")
    )
