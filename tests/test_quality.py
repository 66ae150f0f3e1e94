import random

import pytest

from clicklake.operators import quality as Q


@pytest.fixture
def feed(spark):
    return spark.createDataFrame(
        [
            ("1", "1000", "E100", "view", "Electronics", "2026-05-11T10:00:00"),
            ("2", "999", "E100", "tap", "Books", "2026-05-11T11:00:00.000001"),
            ("2", "x", "X9", "view", "Electronics", "bad"),
            (None, None, None, None, None, None),
            ("3", "1100", "B300", "purchase", None, "2026-05-10T09:59:59"),
        ],
        "event_id string, user_id string, product_id string, event_type string, category string, timestamp string",
    )


@pytest.fixture
def catalogue(spark):
    return spark.createDataFrame([("E100", "Electronics"), ("B300", "Books")], "product_id string, category string")


def test_missing_fields(feed, rows):
    assert dict(rows(Q.missing_fields(feed, ["event_id", "category"]))) == {"event_id": 1, "category": 2}


def test_rules_count_violations_but_not_nulls(feed, rows):
    rules = {
        "user": Q.outside_range("user_id", 1000, 1100),
        "type": Q.outside_set("event_type", ["view", "add_to_cart", "purchase"]),
        "time": Q.bad_time("timestamp", "2026-05-11 10:00:00", "2026-05-11 11:00:00"),
    }
    assert dict(rows(Q.rule_counts(feed, rules))) == {"user": 2, "type": 1, "time": 3}


def test_unknown_products(feed, catalogue, rows):
    assert rows(Q.unknown_products(feed, catalogue)) == sorted([("X9", 1), (None, 1)], key=repr)


def test_duplicates(feed, rows):
    assert rows(Q.duplicate_ids(feed)) == [("2", 2)]


def test_category_mismatch_is_null_safe_and_only_for_known_products(feed, catalogue, rows):
    assert rows(Q.category_mismatches(feed, catalogue)) == [("B300", None, 1, "Books"), ("E100", "Books", 1, "Electronics")]


@pytest.mark.parametrize("chunk", [1, 7, 100, 1_000_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_order_violations_equal_brute_force_for_any_chunk(spark, chunk, seed):
    draw = random.Random(seed)
    events = [(i, draw.choices(["hot", None, f"u{draw.randrange(9)}"], [4, 1, 7])[0], i + draw.choice([0, 0, 0, -5, 9])) for i in range(600)]
    events += draw.sample(events, 50)  # delivered twice
    frame = spark.createDataFrame(events, "event_id bigint, user_id string, event_time bigint")
    expected = {}
    for user in {u for _, u, _ in events}:
        own = sorted((i, t) for i, u, t in events if u == user)
        expected[user] = (len(own), sum(b[1] < a[1] for a, b in zip(own, own[1:])))
    got = {r.user_id: (r.events, r.violations) for r in Q.order_violations(frame, chunk=chunk).collect()}
    assert got == expected
