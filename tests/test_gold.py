from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemart.functions.measures import mean_money, unit_conversion
from tidemart.operators import metrics
from tidemart.plans import gold

D1, D2 = "2024-02-01", "2024-02-02"


def _item(product, quantity=1, price="1.00", category="c", brand="b"):
    total = Decimal(price) * quantity
    return (product, quantity, Decimal(price), total, category, brand)


def test_customer_join_forms(silver_inputs):
    views, purchases = silver_inputs
    v = views(*[(f"{d} 10:00:00", "u", "s", "p") for d in (D1, D2)])
    p = purchases(*[(f"{d} 11:00:00", "u", "5.00") for d in (D1, D2)], (f"{D1} 12:00:00", "w", "7.00"))
    assert gold.daily_customer_analytics(v, p, D1).count() == 2 * 2 + 1
    dated = gold.daily_customer_analytics(v, p, D1, same_day=True).orderBy("user_id", "date").collect()
    assert [(r.user_id, str(r.date), r.total_revenue) for r in dated] == [
        ("u", D1, Decimal("5.00")), ("u", D2, Decimal("5.00")), ("w", D1, Decimal("7.00")),
    ]
    # On one day the two forms agree.
    one_day = [gold.daily_customer_analytics(v, p, D2, same_day=s).drop("created_at") for s in (True, False)]
    assert one_day[0].collect() == one_day[1].collect()


def test_customer_defaults_and_distincts(silver_inputs):
    views, purchases = silver_inputs
    v = views(
        (f"{D1} 09:00:00", "u", "s1", "p1"), (f"{D1} 10:00:00", "u", "s1", None),
        (f"{D1} 11:00:00", "u", "s2", "p1"), (f"{D1} 12:00:00", "u", None, "p2"),
    )
    p = purchases((f"{D1} 11:00:00", "w", "5.00"), (f"{D1} 11:00:00", "w", "5.01"))
    u, w = gold.daily_customer_analytics(v, p, D1).orderBy("user_id").collect()
    assert (u.page_views, u.unique_sessions, u.unique_products_viewed) == (4, 2, 2)
    assert (u.first_visit_time.hour, u.last_activity_time.hour) == (9, 12)
    assert (u.total_purchases, u.total_revenue, u.avg_order_value) == (0, 0, 0)
    assert (w.page_views, w.first_visit_time) == (0, None)
    assert (w.total_revenue, w.avg_order_value) == (Decimal("10.01"), Decimal("5.005000"))


@pytest.mark.parametrize(
    ("amounts", "seen", "segment"),
    [
        (["1000.00"], 0, "high_value"),
        (["999.99"], 0, "medium_value"),
        (["60.00", "40.00"], 50, "medium_value"),
        (["99.99"], 50, "low_value"),
        ([], 11, "engaged_browser"),
        ([], 10, "casual_browser"),
        ([], 1, "casual_browser"),
    ],
)
def test_segments(silver_inputs, amounts, seen, segment):
    views, purchases = silver_inputs
    v = views(*[(f"{D1} 10:00:00", "u", "s", "p")] * seen or [("2020-01-01 00:00:00", "x")])
    p = purchases(*[(f"{D1} 11:00:00", "u", a) for a in amounts] or [("2020-01-01 00:00:00", "x")])
    row = gold.daily_customer_analytics(v, p, D1).first()
    assert row.customer_segment == segment


def test_sales_rates_and_one_sided_days(silver_inputs):
    views, purchases = silver_inputs
    v = views((f"{D1} 10:00:00", "u", "s"), (f"{D1} 10:00:00", "w", "s"))
    p = purchases((f"{D2} 11:00:00", "u", "5.00", "card"))
    first, second = gold.daily_sales_summary(v, p, D1).orderBy("date").collect()
    # Traffic without sales: the numerator is missing, so the rates are too.
    assert (first.total_orders, first.conversion_rate, first.revenue_per_visitor) == (0, None, None)
    assert first.top_payment_method is None and first.unique_visitors == 2
    # Sales without traffic: guarded to zero.
    assert (second.total_orders, second.conversion_rate, second.revenue_per_visitor) == (1, 0.0, 0.0)


@pytest.mark.parametrize(
    ("methods", "top"),
    [
        (["b", "a", "b", "a", "c"], "a"),
        (["b", "a", "b"], "b"),
        ([None, None, None, "z"], "z"),
        ([None, None], None),
    ],
)
def test_top_payment_method(silver_inputs, methods, top):
    _, purchases = silver_inputs
    p = purchases(*[(f"{D1} 10:00:00", f"u{i}", "1.00", m) for i, m in enumerate(methods)])
    row = metrics.sales_metrics(p, D1).first()
    assert (row.top_payment_method, row.total_orders) == (top, len(methods))


def test_sales_measures_equal_the_plain_aggregates(spark, silver_inputs):
    from conftest import TINY

    from tidemart.sources.given import page_views, purchases

    p, v = purchases(spark, TINY), page_views(spark, TINY)
    day = F.to_date("timestamp").alias("date")
    plain = p.groupBy(day).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("total_amount").alias("avg_order_value"),
        F.countDistinct("user_id").alias("unique_customers"),
        F.expr("mode() WITHIN GROUP (ORDER BY payment_method)").alias("top_payment_method"),
    )
    ours = metrics.sales_metrics(p, "2024-01-01")
    assert ours.schema.simpleString() == plain.schema.simpleString()
    assert sorted(ours.collect()) == sorted(plain.collect())
    plain = v.groupBy("user_id", day).agg(
        F.count(F.lit(1)).alias("page_views"),
        F.countDistinct("session_id").alias("unique_sessions"),
        F.countDistinct("product_id").alias("unique_products_viewed"),
        F.min("timestamp").alias("first_visit_time"),
        F.max("timestamp").alias("last_activity_time"),
    )
    assert sorted(metrics.page_view_metrics(v, "2024-01-01").collect()) == sorted(plain.collect())


def test_products(silver_inputs):
    views, purchases = silver_inputs
    v = views(
        (f"{D1} 10:00:00", "u", "s", "both"), (f"{D1} 10:00:00", "u", "s", "both"),
        (f"{D1} 10:00:00", "w", "s", "both"), (f"{D1} 10:00:00", "w", "s", "seen"),
        (f"{D1} 10:00:00", "w", "s", None),
    )
    p = purchases(
        (f"{D1} 11:00:00", "u", "1.00", "m", [_item("both", 2, "1.00", "c1", "b2"), _item("both", 5, "2.00", "c2", "b1")]),
        (f"{D1} 11:00:00", "u", "1.00", "m", [_item("bought"), _item(None)]),
        (f"{D1} 11:00:00", "u", "1.00", "m", []),
        (f"{D1} 11:00:00", "u", "1.00", "m", None),
    )
    rows = {r.product_id: r for r in gold.product_performance_analytics(v, p, D1).collect()}
    assert set(rows) == {"both", "seen", "bought", None}
    both = rows["both"]
    assert (both.total_views, both.unique_viewers, both.total_purchases) == (3, 2, 7)
    assert (both.category, both.brand) == ("c2", "b2")
    assert both.conversion_rate == Decimal("2.33333333333")
    assert (both.total_revenue, both.avg_price) == (Decimal("12.00"), Decimal("1.500000"))
    assert rows["seen"].conversion_rate is None and rows["seen"].total_purchases == 0
    assert rows["bought"].conversion_rate == 0 and rows["bought"].total_views == 0
    assert rows[None].total_purchases == 1
    assert {r.date for r in rows.values()} == {date(2024, 2, 1)}


def test_output_columns_and_types(silver_inputs):
    views, purchases = silver_inputs
    v, p = views((f"{D1} 10:00:00", "u")), purchases((f"{D1} 10:00:00", "u", "1.00"))
    shape = lambda rows: [f"{n} {t}" for n, t in rows.dtypes]
    assert shape(gold.daily_customer_analytics(v, p, D1)) == [
        "user_id string", "date date", "page_views bigint", "unique_sessions bigint",
        "unique_products_viewed bigint", "total_purchases bigint", "total_revenue decimal(20,2)",
        "avg_order_value decimal(14,6)", "first_visit_time timestamp",
        "last_activity_time timestamp", "customer_segment string", "created_at timestamp",
    ]
    assert shape(gold.daily_sales_summary(v, p, D1)) == [
        "date date", "total_orders bigint", "total_revenue decimal(20,2)",
        "avg_order_value decimal(14,6)", "unique_customers bigint", "top_payment_method string",
        "total_page_views bigint", "unique_visitors bigint", "total_sessions bigint",
        "conversion_rate double", "revenue_per_visitor double", "created_at timestamp",
    ]
    assert shape(gold.product_performance_analytics(v, p, D1)) == [
        "product_id string", "category string", "brand string", "date date", "total_views bigint",
        "total_purchases bigint", "conversion_rate decimal(21,11)", "total_revenue decimal(20,2)",
        "avg_price decimal(14,6)", "unique_viewers bigint", "created_at timestamp",
    ]


def test_events_without_time_are_left_out(silver_inputs):
    views, purchases = silver_inputs
    v, p = views((None, "u", "s", "p")), purchases((None, "u", "1.00"))
    assert gold.daily_customer_analytics(v, p, "1970-01-01").count() == 0


def test_conversion_beyond_ten_digits(spark):
    rows = spark.createDataFrame(
        [(10**10, 3), (7, 10**11), (1, 3), (None, 5), (5, 0), (2, 10**10)], "units bigint, views bigint"
    )
    got = [r.c for r in rows.select(unit_conversion(F.col("units"), F.col("views")).alias("c")).collect()]
    assert got == [
        Decimal("3333333333.33333333333"), Decimal("0.00000000007"), Decimal("0.33333333333"),
        None, Decimal(0), Decimal("0.00000000020"),
    ]


def test_mean_equals_avg(spark):
    rows = spark.range(20000).select(
        (F.col("id") % 97).alias("g"),
        ((F.xxhash64("id") % 99999999) / 100).cast("decimal(10,2)").alias("x"),
    )
    both = rows.groupBy("g").agg(
        F.avg("x").alias("a"), mean_money(F.sum("x"), F.count("x")).alias("b")
    )
    assert both.where("a != b OR a IS NULL").count() == 0


def test_hot_key_gives_the_same_rows(spark, silver_inputs):
    """One user with a third of all rows; the result does not depend on the partitioning."""
    base = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 500)).alias("user_id"),
        F.timestamp_seconds(F.lit(1706745600) + F.col("id") % 172800).alias("timestamp"),
        F.concat(F.lit("s"), F.col("id") % 7001).alias("session_id"),
        F.concat(F.lit("p"), F.col("id") % 301).alias("product_id"),
    )
    results = []
    for n in (1, 8):
        got = metrics.page_view_metrics(base.repartition(n), D1)
        results.append(sorted(got.collect()))
    assert results[0] == results[1]
    hot = [r for r in results[0] if r.user_id == "hot"]
    assert sum(r.page_views for r in hot) == 10000


def test_totals_of_the_user_only_join_without_its_rows(spark, silver_inputs):
    """Same totals as the table itself, from users with many days, one side only, and no user at all."""
    import random

    from tidemart.operators import totals

    random.seed(3)
    views, purchases = silver_inputs
    users = ["a", "b", "c", "d", None]
    days = [f"2024-02-{d:02d} 10:00:00" for d in range(1, 9)]
    v = views(*[(random.choice(days), random.choice(users[:4] + [None]), "s", "p") for _ in range(60)])
    p = purchases(*[(random.choice(days), random.choice(users[1:] + ["e"]), random.choice(["5.00", "999.99", "1000.00", None])) for _ in range(40)])
    for some_v, some_p in ((v, p), (v, p.where("false")), (v.where("false"), p)):
        table = gold.daily_customer_analytics(some_v, some_p, D1)
        want = table.agg(*totals.customer_totals()).first()
        got = totals.joined_on_user_totals(some_v, some_p, D1).first()
        assert (got.total_customers, got.high_value_customers, got.total_revenue) == tuple(want)
    joins = totals.joined_on_user_totals(v, p, D1)._jdf.queryExecution().executedPlan().toString()
    assert joins.count("Join") == joins.count("FullOuter") >= 1
