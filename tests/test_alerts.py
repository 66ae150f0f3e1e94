import random
from datetime import datetime, timedelta

import pytest

from clicklake.operators.alerts import flash_sale_alerts
from clicklake.schema import AlertRule

T0 = datetime(2026, 5, 11, 10)


def feed(clicks, product, views, purchases, at="2026-05-11 10:00:30"):
    return [("u", product, "view", at)] * views + [("u", product, "purchase", at)] * purchases


def test_thresholds(clicks):
    events = clicks(*feed(clicks, "four", 4, 0), *feed(clicks, "five", 5, 2), *feed(clicks, "bought", 9, 3))
    alerts = flash_sale_alerts(events).collect()
    assert {a.product_id for a in alerts} == {"five"}
    assert {(a.view_count, a.purchase_count, a.action) for a in alerts} == {(5, 2, "Flash Sale Recommended")}
    assert sorted(a.start for a in alerts) == [T0 - timedelta(minutes=m) for m in (4, 3, 2, 1, 0)]
    assert all(a.end - a.start == timedelta(minutes=5) for a in alerts)


def test_window_bounds_are_half_open(clicks):
    alerts = flash_sale_alerts(clicks(*feed(clicks, "p", 5, 0, "2026-05-11 10:05:00"))).collect()
    assert min(a.start for a in alerts) == T0 + timedelta(minutes=1)
    assert max(a.start for a in alerts) == T0 + timedelta(minutes=5)


def brute_force(events, rule):
    """Count every window start on the slide grid for every product."""
    size, slide = rule.window_seconds, rule.slide_seconds
    counted = {}
    for product, kind, at in events:
        second = int((at - datetime(1970, 1, 1)).total_seconds())
        start = second // slide * slide
        while start > second - size:
            views, purchases = counted.get((product, start), (0, 0))
            counted[product, start] = (views + (kind == "view"), purchases + (kind == "purchase"))
            start -= slide
    return sorted(
        (product, start, v, p) for (product, start), (v, p) in counted.items() if v >= rule.min_views and p < rule.purchases_below
    )


@pytest.mark.parametrize(
    "rule", [AlertRule(), AlertRule(600, 120, 3, 2), AlertRule(300, 300, 2, 9), AlertRule(300, 70, 3, 2), AlertRule(300, 60, 0, 1)]
)
def test_equals_brute_force_with_a_hot_product(clicks, rule):
    draw = random.Random(7)
    events = []
    for _ in range(900):
        product = "hot" if draw.random() < 0.34 else f"p{draw.randrange(12)}"
        kind = draw.choices(["view", "add_to_cart", "purchase"], [70, 25, 5])[0]
        events.append((product, kind, T0 + timedelta(seconds=draw.randrange(3600))))
    found = flash_sale_alerts(clicks(*[("u", p, k, str(at)) for p, k, at in events]), rule).collect()
    got = sorted((a.product_id, int((a.start - datetime(1970, 1, 1)).total_seconds()), a.view_count, a.purchase_count) for a in found)
    assert got == brute_force(events, rule)
