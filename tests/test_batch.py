"""Counts, segments, ranks, conversion and report text on hand-built rows."""

import pytest

from clicklake import schema as S
from clicklake.operators import activity as A
from clicklake.operators import conversion as C
from clicklake.operators import products as P
from clicklake.operators import reports as R
from clicklake.operators import segments as G

DAY = "2026-05-11 10:00:00"


def counts(spark, *rows):
    return spark.createDataFrame(rows, "user_id string, views bigint, purchases bigint")


def test_activity_keeps_null_keys_and_counts_null_types_for_nothing(clicks, rows):
    events = clicks(("u", "p", "view", DAY), ("u", "p", None, DAY), (None, "p", "purchase", DAY), ("w", "p", "other", DAY))
    assert rows(A.user_activity(events)) == sorted([("u", 1, 0), (None, 0, 1), ("w", 0, 0)], key=repr)


def test_segment_rules(spark):
    users = counts(spark, ("a", 0, 0), ("b", 4, 0), ("c", 5, 0), ("d", 5, 1), ("e", 0, 1))
    three = {r.user_id: r.segment for r in G.segments_three_way(users).collect()}
    two = {r.user_id: r.segment for r in G.segments_two_way(users).collect()}
    assert three == {"a": S.CASUAL, "b": S.CASUAL, "c": S.WINDOW_SHOPPER, "d": S.BUYER, "e": S.BUYER}
    assert two == {"a": S.WINDOW_SHOPPER, "b": S.WINDOW_SHOPPER, "c": S.WINDOW_SHOPPER, "d": S.BUYER, "e": S.BUYER}


def test_distribution_and_lines(spark, rows):
    users = G.segments_three_way(counts(spark, ("a", 0, 0), ("b", 1, 0), ("c", 5, 2)))
    distribution = G.segment_distribution(users)
    assert rows(distribution) == [("Buyer", 1), ("Casual Visitor", 2)]
    assert rows(R.segment_summary_lines(distribution)) == [("Buyer: 1",), ("Casual Visitor: 2",)]


def test_top_products_break_ties_by_id(clicks):
    events = clicks(*[("u", p, "view", DAY) for p in "fbdace"], ("u", "a", "purchase", DAY))
    assert [tuple(r) for r in P.top_products(events).collect()] == [(p, 1) for p in "abcde"]
    daily = P.daily_top_products(events, k=2).orderBy("rank").collect()
    assert [(r.product_id, r.rank) for r in daily] == [("a", 1), ("b", 2)]


def test_top_products_of_nothing(clicks):
    assert P.top_products(clicks(("u", "p", "purchase", DAY))).collect() == []


def test_conversion_rate_is_single_precision_and_safe(clicks):
    events = clicks(
        *[("u", "p", "view", DAY, "A")] * 3, ("u", "p", "purchase", DAY, "A"), ("u", "p", "purchase", DAY, "B"),
        ("u", "p", "other", DAY, None), ("u", "p", "view", DAY, ""),
    )
    rates = {r.category: (r.views, r.purchases, r.conversion_rate) for r in C.category_conversion(events).collect()}
    assert rates == {"A": (3, 1, 0.3333333432674408), "B": (0, 1, 0.0), None: (0, 0, 0.0), "": (1, 0, 0.0)}
    assert dict(C.category_conversion(events).dtypes)["conversion_rate"] == "double"


def test_rate_order_breaks_ties_by_name(clicks):
    events = clicks(*[("u", "p", "view", DAY, c) for c in "CBA"], ("u", "p", "purchase", DAY, "B"))
    ordered = C.ordered_by_rate(C.category_conversion(events)).collect()
    assert [r.category for r in ordered] == ["B", "A", "C"]


def test_catalogue_gives_the_same_rates_as_labelled_events(spark, clicks, rows):
    pairs = [("e1", "Electronics"), ("e2", "Electronics"), ("c1", "Clothing"), ("s1", "Sports")]
    catalogue = spark.createDataFrame(pairs, "product_id string, category string")
    products = ["e1", "e2", "c1", "s1", "X1", None]
    events = clicks(*[(str(i), products[i % 6], ("view", "purchase", "view")[i % 3], DAY) for i in range(60)]).drop("category")
    direct = C.category_conversion(C.enrich_category(events, catalogue))
    assert rows(C.catalogue_conversion(events, catalogue)) == rows(direct)
    assert {r.category for r in direct.collect()} == {"Electronics", "Clothing", "Sports", "Other"}


def test_lookup_falls_back_to_the_own_category_and_then_to_other(spark, clicks, rows):
    catalogue = spark.createDataFrame([("a", "A"), ("n", None)], "product_id string, category string")
    events = clicks(*[("u", p, "view", DAY, c) for p, c in [("a", "X"), ("b", "X"), ("b", None), ("n", "Y"), (None, None)]])
    got = rows(C.enrich_category(events, catalogue).select("event_id", "category"))
    assert got == [(0, "A"), (1, "X"), (2, "Other"), (3, "Y"), (4, "Other")]
    assert rows(C.enrich_category(events.drop("category"), catalogue, None).select("category").distinct()) == sorted([("A",), (None,)], key=repr)


def test_a_product_listed_twice_counts_once(spark, clicks, rows):
    catalogue = spark.createDataFrame([("a", "Z"), ("a", "B"), ("a", ""), ("n", "")], "product_id string, category string")
    events = clicks(("u", "a", "view", DAY, "own"), ("u", "a", "purchase", DAY, "own"), ("u", "n", "view", DAY, ""))
    assert [(r.category, r.views, r.purchases) for r in C.catalogue_conversion(events, catalogue).orderBy("category").collect()] == [("B", 1, 1), ("Other", 1, 0)]
    assert rows(C.enrich_category(events, catalogue).select("category")) == [("B",), ("B",), ("Other",)]


def test_run_statistics_ignore_null_keys(clicks):
    events = clicks(("u", "p", "view", DAY), ("u", None, "view", DAY), (None, "q", "view", DAY))
    assert tuple(A.run_statistics(events).first()) == (3, 2, 1)
    assert tuple(A.run_statistics(events, approximate=True).first()) == (3, 2, 1)


def text(lines):
    return [r.line for r in lines.orderBy("report_date", "line_no").collect()]


def test_top_products_text(clicks):
    events = clicks(("u", "E100", "view", DAY), ("u", "E100", "view", DAY), ("u", None, "view", DAY), ("u", "Z", "purchase", DAY))
    lines = R.top_products_lines(A.activity(events, "event_date", "product_id"))
    assert text(lines) == ["Top 5 Most Viewed Products:", "-" * 30, "Product: E100 | Views: 2", "Product: None | Views: 1"]
    one = R.top_products_lines(A.activity(events, "event_date", "product_id"), k=1)
    assert text(one) == ["Top 1 Most Viewed Products:", "-" * 30, "Product: E100 | Views: 2"]


def test_a_day_without_views_keeps_its_heading(clicks):
    events = clicks(*[("u", p, "purchase", DAY) for p in "abcdefgh"])
    lines = R.top_products_lines(A.activity(events, "event_date", "product_id"))
    assert text(lines) == ["Top 5 Most Viewed Products:", "-" * 30]


@pytest.mark.parametrize(
    ("views", "purchases", "shown"),
    [(3, 1, " 33.33%"[1:]), (32, 1, " 3.12%"), (32, 3, " 9.38%"), (1, 1, "100.00%"), (0, 4, " 0.00%"), (1, 25, "2500.00%")],
)
def test_conversion_text_rounds_as_a_percent_format_does(spark, views, purchases, shown):
    one = spark.createDataFrame([("2026-05-11", "Books", views, purchases)], "event_date string, category string, views bigint, purchases bigint")
    lines = text(R.conversion_lines(C.with_conversion_rate(one)))
    assert lines[2] == f"Category: {'Books':12} | CR: {shown} (Views: {views}, Purchases: {purchases})"


def test_percent_text_equals_python_formatting_for_all_small_ratios(spark):
    pairs = [(v, p) for v in range(1, 129) for p in range(0, v + 1, 3)]
    frame = spark.createDataFrame([("d", f"{v}/{p}", v, p) for v, p in pairs], "event_date string, category string, views bigint, purchases bigint")
    lines = R.conversion_lines(C.with_conversion_rate(frame)).where("line_no > 2").collect()
    rates = {r.category: r.conversion_rate for r in C.with_conversion_rate(frame).collect()}
    expected = {
        f"Category: {f'{v}/{p}':12} | CR: {rates[f'{v}/{p}']:6.2%} (Views: {v}, Purchases: {p})" for v, p in pairs
    }
    assert {r.line for r in lines} == expected


def test_missing_and_empty_category_read_other(clicks):
    events = clicks(("u", "p", "view", DAY, None), ("u", "p", "view", DAY, ""), ("u", "p", "view", DAY, "A"))
    lines = text(R.conversion_lines(C.category_conversion(events, "event_date")))
    assert lines[:2] == ["Category Conversion Rates:", "-" * 30]
    assert sum(line.startswith("Category: Other        |") for line in lines) == 2 and len(lines) == 5


def test_report_body(clicks):
    events = clicks(("u", "p", "view", DAY, "A"), ("u", "q", "view", "2026-05-12 00:00:00", "A"))
    top = R.top_products_lines(A.activity(events, "event_date", "product_id"))
    rates = R.conversion_lines(C.category_conversion(events, "event_date"))
    bodies = {str(r.report_date): r.body for r in R.daily_report_body(top, rates, "/r/").collect()}
    assert bodies.keys() == {"2026-05-11", "2026-05-12"}
    assert 'padding: 10px; border: 1px solid #ddd;">' + "Top 5 Most Viewed Products:\n" + "-" * 30 + "\nProduct: p | Views: 1</pre>" in bodies["2026-05-11"]
    assert "Daily Analytics Report - 2026-05-12" in bodies["2026-05-12"]
    assert "/r/*/report_date=2026-05-12" in bodies["2026-05-12"]
