"""The gold tables against plain Python on small random inputs."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest

from tidemart.plans import gold

DAY = date(2024, 2, 2)
FIRST = datetime(2024, 2, 1)


def _rounded(value, digits):
    return value.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)


def _inputs(seed):
    """A third of all rows belong to one user; some sessions, products and times are missing."""
    rng = random.Random(seed)

    def pick(values, missing=0.1):
        return None if rng.random() < missing else rng.choice(values)

    def user():
        return "hot" if rng.random() < 1 / 3 else f"u{rng.randrange(12)}"

    def moment():
        made = FIRST + timedelta(seconds=rng.randrange(4 * 86400))
        return None if rng.random() < 0.05 else made

    views = [
        (moment(), user(), pick([f"s{i}" for i in range(9)]), pick([f"p{i}" for i in range(7)]))
        for _ in range(150)
    ]
    purchases = []
    for _ in range(80):
        items = [
            (pick([f"p{i}" for i in range(4, 11)]), rng.randint(1, 3), Decimal(rng.randint(1, 99999)) / 100,
             Decimal(rng.randint(1, 99999)) / 100, rng.choice("xyz"), pick(["b1", "b2"]))
            for _ in range(rng.randrange(4))
        ]
        amount = Decimal(rng.randint(1, 99999)) / 100
        purchases.append((moment(), user(), str(amount), pick(["card", "cash", "gift"]), items or None))
    return views, purchases


def _in_range(rows):
    return [r for r in rows if r[0] is not None and r[0].date() >= DAY]


@pytest.fixture(params=[1, 2, 3])
def case(request, silver_inputs):
    views, purchases = _inputs(request.param)
    as_text = lambda rows: [(r[0] and str(r[0]), *r[1:]) for r in rows]
    make_views, make_purchases = silver_inputs
    frames = make_views(*as_text(views)), make_purchases(*as_text(purchases))
    return frames, _in_range(views), _in_range(purchases)


def _grouped(rows, key):
    groups = defaultdict(list)
    for row in rows:
        groups[key(row)].append(row)
    return groups


def _distinct(rows, position):
    return len({r[position] for r in rows} - {None})


def test_customers(case):
    (v, p), views, purchases = case
    by_key = lambda r: (r[1], r[0].date())
    seen, bought = _grouped(views, by_key), _grouped(purchases, by_key)
    for same_day in (True, False):
        pairs = [(a, b) for a in seen for b in bought if a[0] == b[0] and (not same_day or a == b)]
        pairs += [(a, None) for a in seen if a not in {x for x, _ in pairs}]
        pairs += [(None, b) for b in bought if b not in {y for _, y in pairs}]
        wanted = []
        for a, b in pairs:
            mine, paid = seen.get(a, []), [Decimal(r[2]) for r in bought.get(b, [])]
            mean = _rounded(sum(paid) / len(paid), 6) if paid else Decimal(0)
            times = [r[0] for r in mine]
            wanted.append(
                (*(a or b), len(mine), _distinct(mine, 2), _distinct(mine, 3), len(paid), sum(paid, Decimal(0)),
                 mean, min(times, default=None), max(times, default=None))
            )
        got = gold.daily_customer_analytics(v, p, DAY, same_day=same_day).drop("customer_segment", "created_at")
        assert sorted(map(str, (tuple(_plain(r)) for r in got.collect()))) == sorted(
            map(str, (tuple(_plain(r)) for r in wanted))
        )


def _plain(row):
    return [x.normalize() if isinstance(x, Decimal) else x for x in row]


def test_sales(case):
    (v, p), views, purchases = case
    seen, bought = (_grouped(rows, lambda r: r[0].date()) for rows in (views, purchases))
    got = {r.date: r for r in gold.daily_sales_summary(v, p, DAY).collect()}
    assert set(got) == set(seen) | set(bought)
    for day, row in got.items():
        mine, paid = seen.get(day, []), [Decimal(r[2]) for r in bought.get(day, [])]
        assert (row.total_page_views, row.unique_visitors, row.total_sessions) == (
            len(mine), _distinct(mine, 1), _distinct(mine, 2),
        )
        buyers = _distinct(bought.get(day, []), 1)
        assert (row.total_orders, row.total_revenue, row.unique_customers) == (len(paid), sum(paid), buyers)
        assert row.avg_order_value == _rounded(sum(paid) / len(paid), 6)
        methods = Counter(r[3] for r in bought[day] if r[3])
        assert row.top_payment_method == min(methods, key=lambda m: (-methods[m], m))
        assert row.conversion_rate == pytest.approx(buyers / _distinct(mine, 1))
        assert row.revenue_per_visitor == pytest.approx(float(sum(paid)) / _distinct(mine, 1))


def test_products(case):
    (v, p), views, purchases = case
    seen = _grouped([r for r in views if r[3]], lambda r: r[3])
    bought = _grouped([i for r in purchases for i in r[4] or []], lambda i: i[0])
    got = {r.product_id: r for r in gold.product_performance_analytics(v, p, DAY).collect()}
    assert set(got) == set(seen) | set(bought)
    for product, row in got.items():
        mine, items = seen.get(product, []), bought.get(product, [])
        units = sum(i[1] for i in items)
        assert (row.total_views, row.unique_viewers, row.total_purchases) == (len(mine), _distinct(mine, 1), units)
        assert row.total_revenue == sum(i[3] for i in items)
        assert row.category == max((i[4] for i in items), default=None)
        assert row.brand == max((i[5] for i in items if i[5]), default=None)
        if items:
            assert row.avg_price == _rounded(sum(i[2] for i in items) / len(items), 6)
        if not mine:
            assert row.conversion_rate == 0
        else:
            assert row.conversion_rate == (_rounded(Decimal(units) / len(mine), 11) if items else None)
