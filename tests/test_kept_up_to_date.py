"""Totals and arrival order kept up to date by streams, the state audit, and the lookup in dated catalogues: restarts, skew and odd rows."""

import json
import os
import random
import shutil
from collections import Counter
from datetime import datetime, timedelta

import pytest

from clicklake import schema as S
from clicklake.operators.activity import daily_user_activity
from clicklake.operators.alerts import flash_sale_alerts
from clicklake.operators.conversion import category_conversion
from clicklake.operators.decode import archivable, decode_events, with_event_date
from clicklake.operators.quality import order_violations
from clicklake.operators.validity import enrich_category_as_of
from clicklake.session import stream_session
from clicklake.sources import files
from clicklake.streaming.alerts import alert_rows, alert_writer, start_alerts
from clicklake.streaming.audit import open_windows, state_operators
from clicklake.streaming.order import order_violations_so_far, start_order_check
from clicklake.streaming.run import wait
from clicklake.streaming.totals import daily_category_totals, daily_user_totals, drop_old_totals, start_daily_totals


def event(user="u", time="2026-05-11T10:00:00", i=0, kind="view", category="A", product="p"):
    return json.dumps({"event_id": str(i), "user_id": user, "product_id": product, "event_type": kind, "category": category, "timestamp": time})


class Topic:
    def __init__(self, spark, folder):
        self.spark, self.path, self.out, self.parts = spark, folder / "topic", str(folder / "out"), 0
        self.path.mkdir()

    def deliver(self, *messages):
        self.parts += 1
        (self.path / f"{self.parts:03d}.txt").write_text("\n".join(messages) + "\n")

    def events(self):
        return decode_events(files.read_messages(self.spark, str(self.path)))

    def totals(self):
        wait(start_daily_totals(files.stream_messages(self.spark, str(self.path)), self.out, every=None))
        return daily_user_totals(self.spark, self.out)

    def check_order(self, **options):
        events = decode_events(files.stream_messages(self.spark, str(self.path)), "event_id", "user_id", "timestamp")
        wait(start_order_check(events, self.out, every=None, **options))
        return {r.user_id: (r.events, r.violations) for r in order_violations_so_far(self.spark, self.out).collect()}

    def expected_order(self):
        numbered = self.events().where("timestamp is not null").selectExpr("user_id", "cast(event_id as bigint) as event_id", "event_time")
        return {r.user_id: (r.events, r.violations) for r in order_violations(numbered).collect()}

    def forget_commit(self, name, batch):
        """As if the job had died after its last write and before the commit."""
        commits = f"{self.out}/{S.CHECKPOINTS}/{name}/commits"
        for file in (str(batch), f".{batch}.crc"):
            if os.path.exists(f"{commits}/{file}"):
                os.remove(f"{commits}/{file}")


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path)


def test_totals_equal_the_batch_queries_over_restarts(topic, rows):
    rng = random.Random(4)
    for part in range(3):
        topic.deliver(*[event(rng.choice(["hot", "hot", "a", None, ""]), f"2026-05-{rng.randrange(10, 14 + part)}T10:00:00", i, rng.choice(["view", "purchase", "x"]),
                              rng.choice(["A", "B", "", None])) for i in range(120)], "not json", event(time="some day"))
        totals = topic.totals()
    dated = with_event_date(archivable(topic.events()))
    assert rows(totals) == rows(daily_user_activity(dated)) != []
    expected = category_conversion(dated, "event_date").select("event_date", "category", "views", "purchases", "conversion_rate")
    assert rows(daily_category_totals(topic.spark, topic.out)) == rows(expected)


def test_a_batch_rewrites_only_the_days_it_touches(topic, rows):
    topic.deliver(event("a", "2026-05-11T10:00:00"), event("a", "2026-05-12T10:00:00"))
    topic.totals()
    topic.deliver(event("a", "2026-05-12T11:00:00"))
    assert [r[1:] for r in sorted(map(tuple, topic.totals().collect()))] == [("a", 1, 0), ("a", 2, 0)]
    assert sorted(d for d in os.listdir(f"{topic.out}/totals/batch=1") if d.startswith("event")) == ["event_date=2026-05-12"]


def test_a_killed_batch_of_totals_that_is_run_again_changes_nothing(topic, rows):
    topic.deliver(event("a"), event("b", kind="purchase"))
    topic.totals()
    topic.deliver(event("a"), event("c", "2026-05-12T10:00:00"))
    before = rows(topic.totals())
    topic.forget_commit("daily-totals", 1)
    assert rows(topic.totals()) == before and len(before) == 3
    topic.forget_commit("daily-totals", 1)  # died between the totals and the manifest: readers stay with the batch before
    shutil.rmtree(f"{topic.out}/manifests/batch=1")
    assert len(daily_user_totals(topic.spark, topic.out).collect()) == 2
    assert rows(topic.totals()) == before


def test_old_totals_are_dropped_and_the_current_ones_stay(topic, rows):
    for day in (11, 11, 11, 12):
        topic.deliver(event("a", f"2026-05-{day}T10:00:00"))
        topic.totals()
    before = rows(daily_user_totals(topic.spark, topic.out))
    gone = {os.path.relpath(path, topic.out) for path in drop_old_totals(topic.spark, topic.out, keep=2)}
    assert {"totals/batch=0/event_date=2026-05-11", "totals/batch=1/event_date=2026-05-11", "manifests/batch=0"} <= gone
    assert rows(daily_user_totals(topic.spark, topic.out)) == before
    topic.forget_commit("daily-totals", 3)
    assert rows(topic.totals()) == before
    topic.deliver(event("a", "2026-05-11T10:00:00"))
    assert sorted(r.views for r in topic.totals().collect()) == [1, 4]


def test_totals_of_nothing(topic):
    assert daily_user_totals(topic.spark, topic.out).isEmpty() and drop_old_totals(topic.spark, topic.out) == []
    topic.deliver("not json", event(time="some day"))
    assert topic.totals().isEmpty() and daily_category_totals(topic.spark, topic.out).isEmpty()


@pytest.mark.parametrize("chunk", [7, 1_000_000])
def test_arrival_order_over_restarts_equals_the_table_query(topic, chunk):
    rng = random.Random(chunk)
    n = 0
    for _ in range(4):
        part = []
        for _ in range(150):
            n += 1
            at = datetime(2026, 5, 11) + timedelta(minutes=n + rng.choice([0, 0, 0, -90]))
            part.append(event(rng.choice(["hot", "hot", "hot", "a", "b", None]), "some day" if n % 29 == 0 else at.isoformat(), n))
        topic.deliver(*part)
        got = topic.check_order(chunk=chunk, keep_seconds=None)
    assert got == topic.expected_order() and sum(v for _, v in got.values()) > 20 and None in got


def test_an_edge_between_batches_counts_and_silent_users_are_forgotten(topic):
    topic.deliver(event("a", "2026-05-11T10:00:00", 1), event("b", "2026-05-11T10:00:00", 2))
    topic.check_order(keep_seconds=3600)
    topic.deliver(event("b", "2026-05-11T12:00:00", 3))
    topic.check_order(keep_seconds=3600)
    topic.deliver(event("a", "2026-05-11T09:00:00", 4), event("b", "2026-05-11T11:00:00", 5))
    assert topic.check_order(keep_seconds=3600) == {"a": (2, 0), "b": (3, 1)}
    assert topic.expected_order() == {"a": (2, 1), "b": (3, 1)}


def test_an_order_batch_that_is_run_again_changes_nothing(topic):
    topic.deliver(event("a", "2026-05-11T10:00:00", 1))
    topic.check_order()
    topic.deliver(event("a", "2026-05-11T09:00:00", 2), event("a", "2026-05-11T08:00:00", 3))
    before = topic.check_order()
    topic.forget_commit("order-check", 1)
    assert topic.check_order() == before == {"a": (3, 2)}


def test_order_of_nothing(topic):
    assert order_violations_so_far(topic.spark, topic.out).isEmpty()
    topic.deliver("")
    assert set(topic.check_order()) <= {None}


def test_open_windows_are_the_batch_windows_not_yet_judged(topic, rows):
    rule = S.AlertRule(min_views=0, purchases_below=1000)
    session = stream_session(topic.spark, state_partitions=2)

    def run():
        alerts = alert_rows(files.stream_messages(session, str(topic.path)), rule)
        wait(start_alerts(alert_writer(alerts, f"{topic.out}/cp", "parquet", path=f"{topic.out}/alerts"), every=None))
        return open_windows(topic.spark, f"{topic.out}/cp")

    for hour in (10, 11):
        topic.deliver(*[event(time=f"2026-05-11T{hour}:{m:02d}:00", kind=k, product=p) for m in range(0, 40, 3) for p in "pq" for k in ("view", "purchase", "x")])
        found = run()
        known = topic.events().where("event_time is not null")
        mark = known.selectExpr("max(event_time) - interval 10 minutes as mark").first()["mark"]
        whole = flash_sale_alerts(known, rule).select("start", "end", "product_id", "view_count", "purchase_count")
        assert rows(found) == rows(whole.where(whole.end > mark)) != []
    operators = state_operators(topic.spark, f"{topic.out}/cp").collect()
    assert [(r.operator, r.name, r.state_partitions) for r in operators] == [(0, "stateStoreSave", 2)]
    before = Counter(r.product_id for r in open_windows(topic.spark, f"{topic.out}/cp", batch=0).collect())
    assert set(before) == {"p", "q"}


def as_of(spark, events, catalogue, **options):
    frame = spark.createDataFrame(events, "event_id int, product_id string, at string").selectExpr("event_id", "product_id", "cast(at as timestamp) as event_time")
    dated = spark.createDataFrame(catalogue, "product_id string, category string, a string, b string").selectExpr(
        "product_id", "category", "cast(a as timestamp) as valid_from", "cast(b as timestamp) as valid_to"
    )
    return {r.event_id: r.category for r in enrich_category_as_of(frame, dated, **options).collect()}


def test_the_row_that_was_valid_counts(spark):
    catalogue = [
        ("p", "Old", None, None), ("p", "New", "2026-05-02", "2026-05-04"), ("p", "", "2026-05-06", None), ("p", "Last", "2026-05-08", None),
        ("q", "B", "2026-05-02", None), ("q", "A", "2026-05-02", None), ("q", "", "2026-05-02", None), (None, "None", None, None),
    ]
    asked = [
        ("p", "2020-01-01", "Old"), ("p", "2026-05-01 23:59:59.999999", "Old"), ("p", "2026-05-02", "New"), ("p", "2026-05-03 23:59:59", "New"),
        ("p", "2026-05-04", "Other"), ("p", "2026-05-07", "Other"), ("p", "2030-01-01", "Last"), ("q", "2026-05-01", "Other"),
        ("q", "2026-05-02", "A"), ("r", "2026-05-02", "Other"), (None, "2026-05-02", "Other"), ("p", None, "Other"), (None, None, "Other"),
    ]
    events = [(i, product, at) for i, (product, at, _) in enumerate(asked)]
    expected = {i: category for i, (_, _, category) in enumerate(asked)}
    for cell, splits in ((86_400, 8), (3600, 1), (10**9, 3)):
        assert as_of(spark, events, catalogue, cell_seconds=cell, splits=splits) == expected
    assert set(as_of(spark, events, []).values()) == {"Other"} and as_of(spark, [], catalogue) == {}


@pytest.mark.parametrize("seed", range(3))
def test_dated_categories_equal_brute_force_with_a_hot_product(spark, seed):
    rng = random.Random(seed)
    start = datetime(2026, 5, 1)
    moment = lambda: start + timedelta(hours=rng.randrange(200))
    catalogue = []
    for p in ("hot", "a", "b", "c"):
        for begin in {moment() for _ in range(6)}:
            catalogue.append((p, rng.choice("XYZ"), str(begin), str(begin + timedelta(hours=rng.randrange(1, 90))) if rng.random() < 0.5 else None))
    events = [(i, rng.choice(["hot", "hot", "a", "b", "d"]), str(moment())) for i in range(400)]

    def expected(product, at):
        known = [row for row in catalogue if row[0] == product and row[2] <= at]
        row = max(known, key=lambda r: r[2], default=None)
        return row[1] if row and (row[3] is None or at < row[3]) else "Other"

    assert as_of(spark, events, catalogue, cell_seconds=36_000, splits=4) == {i: expected(p, at) for i, p, at in events}


def test_other_columns_stay_and_a_product_is_split(spark, plan, rows):
    events = spark.sql("SELECT 1 AS at, 'own' AS category, 'p' AS product_id, 'k' AS kind, timestamp'2026-05-01' AS event_time, 'c' AS cell, 's' AS salt, 'v' AS version")
    empty = spark.createDataFrame([], "product_id string, category string, valid_from timestamp, valid_to timestamp")
    found = enrich_category_as_of(events, empty)
    assert found.columns == events.columns and rows(found) == rows(events)
    text = plan(found)
    assert "hashpartitioning(product_id" in text and "salt" in text and "NestedLoop" not in text and "Cartesian" not in text
