"""Silver-shaped inputs and a message stream derived from the given star-schema tables.

Purchase event e takes order e and its line items. Nothing here groups rows: every derived row
comes from one event, or from one event joined with one line item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.messages import topic_for

# The event type each given type stands for.
EVENT_OF_GIVEN = {
    "view": "page_view",
    "click": "add_to_cart",
    "purchase": "purchase",
    "signup": "user_session",
    "error": "product_update",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _pick(values: list[str], number: Column) -> Column:
    """One of the values by number; the list is a literal."""
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


def _props_k() -> Column:
    return F.get_json_object("props", "$.k")


def page_views(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("event_id")
    return (
        table(spark, folder, "events")
        .where(F.col("event_type") == "view")
        .select(
            _text("event_id").alias("event_id"),
            F.col("ts").alias("timestamp"),
            _text("user_id").alias("user_id"),
            F.concat(F.lit("s"), (number % 977).cast("string")).alias("session_id"),
            F.when(number % 10 != 0, _props_k()).alias("product_id"),
            _pick(["product_detail", "category", "search_results", "home"], number).alias("page_type"),
        )
    )


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    """One row per purchase event; the order's priority plays the payment method."""
    events = table(spark, folder, "events").where(F.col("event_type") == "purchase")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return events.join(orders, F.col("o_orderkey") == F.col("event_id")).select(
        _text("event_id").alias("event_id"),
        F.col("ts").alias("timestamp"),
        _text("user_id").alias("user_id"),
        F.col("value").cast("decimal(10,2)").alias("total_amount"),
        F.col("o_orderpriority").alias("payment_method"),
    )


def purchases_by_line(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases with items, one row per line item: ``items`` holds that one line.

    Purchases without line items keep a row with NULL items. Collecting an order's lines into
    one array would put an order of any size into one row, and what reads this unnests it
    again.
    """
    events = (
        table(spark, folder, "events")
        .where(F.col("event_type") == "purchase")
        .select("event_id", F.col("ts").alias("timestamp"))
    )
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"
    )
    parts = table(spark, folder, "part").select("p_partkey", "p_retailprice", "p_type", "p_brand")
    item = F.struct(
        _text("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("total_price"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
    )
    bought = events.join(lines, F.col("l_orderkey") == F.col("event_id"), "left")
    described = bought.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    return described.select(
        _text("event_id").alias("event_id"),
        "timestamp",
        F.when(F.col("p_partkey").isNotNull(), F.array(item)).alias("items"),
    )


def _payload(event: Column, kind: Column, number: Column) -> Column:
    """The JSON text of one event. Fields that do not belong to its type are NULL and left out."""

    def only(given: str, value: Column) -> Column:
        return F.when(event == given, value)

    def every(n: int) -> Column:
        return number % n == 0

    k = F.col("k")
    amount = F.col("value").cast("decimal(12,2)")
    units = (k.cast("int") % 5).cast("int")
    percent = (number % 4 * 5).cast("int")
    item = lambda i: F.struct(
        F.when(i == 1, k).otherwise(F.concat(k, F.lit("-"), i.cast("string"))).alias("product_id"),
        i.alias("quantity"),
        amount.alias("unit_price"),
        (amount * i).cast("decimal(12,2)").alias("total_price"),
        _pick(["Books", "Sports", "Clothing"], number + i).alias("category"),
        F.concat(F.lit("brand-"), (number % 7).cast("string")).alias("brand"),
    )
    count = (number % 4).cast("int")
    items = F.when(count > 0, F.transform(F.sequence(F.lit(1), count), item)).otherwise(
        F.filter(F.transform(F.sequence(F.lit(1), F.lit(1)), item), lambda x: F.lit(False))
    )
    address = F.struct(
        F.concat((number % 100).cast("string"), F.lit(" Main St")).alias("street"),
        _pick(["Lund", "Oslo", "Turku"], number).alias("city"),
        F.lit("XX").alias("state"),
        F.lpad((number % 100000).cast("string"), 5, "0").alias("zip_code"),
        F.lit("US").alias("country"),
    )
    broken_time = F.lit("not-a-time")
    fields = {
        "event_id": F.concat(F.lit("e"), number.cast("string")),
        "event_type": F.when(every(53), F.lit("mystery")).otherwise(kind),
        "timestamp": F.when(every(41), broken_time).otherwise(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        ),
        "user_id": F.when((event != "error") & ~every(31), F.col("uid")),
        "session_id": F.when(event != "error", F.concat(F.lit("s"), (number % 977).cast("string"))),
        "product_id": F.when(~every(31), k),
        "page_type": only("view", _pick(["product_detail", "category", "search_results", "home"], number)),
        "referrer": only("view", F.when(~every(5), _pick(["google.com", "direct", "email"], number))),
        "quantity": only("click", units),
        "price": only("click", amount),
        "total_value": only("click", (amount * units).cast("decimal(12,2)")),
        "cart_id": only("click", F.concat(F.lit("c"), (number % 89).cast("string"))),
        "order_id": only("purchase", F.concat(F.lit("o"), number.cast("string"))),
        "total_amount": only(
            "purchase",
            F.when(every(43), F.lit("123456789.12").cast("decimal(12,2)")).otherwise(amount),
        ),
        "subtotal": only("purchase", (amount + 5).cast("decimal(12,2)")),
        "discount_percent": only("purchase", percent),
        "discount_amount": only("purchase", F.lit("5.005").cast("decimal(12,3)")),
        "payment_method": only("purchase", _pick(["credit_card", "debit_card", "paypal", "apple_pay"], number)),
        "shipping_method": only("purchase", _pick(["standard", "expedited", "overnight"], number)),
        "shipping_address": only("purchase", F.when(~every(6), address)),
        "items": only("purchase", F.when(~every(29), items)),
        "session_type": only("signup", _pick(["login", "logout"], number)),
        "device_type": F.when(event.isin("view", "signup"), _pick(["mobile", "desktop", "tablet"], number)),
        "ip_address": F.when(
            event.isin("view", "signup"), F.concat(F.lit("10.0.0."), (number % 256).cast("string"))
        ),
        "update_type": only("error", _pick(["price_change", "inventory_update", "rating_update"], number)),
        "metadata": F.struct(k.alias("k"), (number % 3 == 0).alias("flag"), (number % 100).alias("depth")),
    }
    body = F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))
    return F.when(every(97), F.lit("{oops")).otherwise(body)


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """The message stream: one message per event, with faults at fixed event numbers.

    No key: every 7th. No user or product id: every 31st. Bad time: every 41st. Too wide an
    amount: every 43rd. Unknown type: every 53rd. Broken JSON: every 97th. Messages arrive two
    seconds after the event.
    """
    kinds = F.create_map(*[F.lit(x) for pair in EVENT_OF_GIVEN.items() for x in pair])
    events = table(spark, folder, "events").select(
        "*",
        F.try_element_at(kinds, "event_type").alias("kind"),
        _text("user_id").alias("uid"),
        _props_k().alias("k"),
    )
    event, kind, number = F.col("event_type"), F.col("kind"), F.col("event_id")
    key = F.when(
        number % 7 != 0, F.when(event == "error", F.col("k")).otherwise(F.col("uid"))
    )
    return events.select(
        key.cast("binary").alias("key"),
        _payload(event, kind, number).cast("binary").alias("value"),
        topic_for(kind).alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        number.alias("offset"),
        (F.col("ts").cast("timestamp") + F.expr("INTERVAL 2 SECONDS")).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
