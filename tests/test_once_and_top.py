"""The archive without repeats and the top products of a stream: restarts, skew, bounds and odd rows."""

import json
import os
import random
from collections import Counter

import pytest

from clicklake import schema as S
from clicklake.operators.decode import decode_events
from clicklake.operators.products import top_products
from clicklake.session import stream_session
from clicklake.sources import files
from clicklake.streaming import top
from clicklake.streaming.once import read_accounts, start_archive_once, wait_and_account
from clicklake.streaming.run import wait
from clicklake.streaming.top import SummarySize, start_top_products, top_products_so_far


def event(i, time="10:00:00", user="u", product="p", kind="view"):
    return json.dumps({"event_id": i, "user_id": user, "product_id": product, "event_type": kind, "category": "A", "timestamp": f"2026-05-11T{time}"})


class Topic:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.path, self.out, self.parts = spark, folder, folder / "topic", str(folder / "out"), 0
        self.path.mkdir()

    def deliver(self, *messages):
        self.parts += 1
        (self.path / f"{self.parts:03d}.txt").write_text("\n".join(messages) + "\n")

    def archive(self):
        session = stream_session(self.spark, state_partitions=2)
        query = start_archive_once(files.stream_messages(session, str(self.path)), self.out, every=None)
        wait_and_account(self.spark, query, f"{self.out}/accounts")
        return files.read_lake(self.spark, self.out)

    def accounts(self):
        rows = read_accounts(self.spark, f"{self.out}/accounts").orderBy("batch").collect()
        return [(r.delivered, r.archived, r.copies, r.behind) for r in rows]

    def count(self, size):
        wait(start_top_products(files.stream_messages(self.spark, str(self.path)), self.out, every=None, size=size))

    def top(self, k):
        return [tuple(r) for r in top_products_so_far(self.spark, self.out, k).collect()]

    def expected(self, k):
        return [tuple(r) for r in top_products(decode_events(files.read_messages(self.spark, str(self.path))), k).collect()]


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path)


def test_an_id_is_archived_once_over_restarts(topic):
    topic.deliver(event("a"), event("a"), event("b", "10:05:00"), event("x", "25:00:00"), "not json")
    assert sorted(r.event_id for r in topic.archive().collect()) == ["a", "b"]
    topic.deliver(event("a"), event("c", "10:01:00"), event("b", "10:05:00"), event("d", "11:00:00"))
    assert sorted(r.event_id for r in topic.archive().collect()) == ["a", "b", "c", "d"]
    topic.deliver(event("a"), event("d", "11:00:00"), event("d", "11:00:00"))
    assert sorted(r.event_id for r in topic.archive().collect()) == ["a", "b", "c", "d"]
    assert topic.accounts() == [(3, 2, 1, 0), (4, 2, 2, 0), (3, 0, 2, 1)]


def test_what_is_archived_equals_what_the_accounts_say(topic):
    rng = random.Random(3)
    sent = [(i, f"10:{i // 60 % 60:02d}:{i % 60:02d}") for i in range(900)]
    hot = [event("hot", "10:14:00")] * 300
    for k in range(3):
        part = [event(str(i), t) for i, t in sent[300 * k : 300 * k + 300]]
        again = [event(str(i), t) for i, t in rng.sample(sent[: 300 * k + 300], 100)]
        topic.deliver(*part, *again, *hot)
        lake = topic.archive()
    ids = Counter(r.event_id for r in lake.collect())
    assert max(ids.values()) == 1 and set(ids) == {str(i) for i, _ in sent} | {"hot"}
    totals = [sum(column) for column in zip(*topic.accounts(), strict=True)]
    assert totals[0] == 3 * 700 and totals[1] == 901 and sum(totals[1:]) == totals[0]


def test_events_without_an_id_are_copies_only_if_all_fields_agree(topic):
    topic.deliver(event(None, user="a"), event(None, user="a"), event(None, user="b"), event(None, user="a", kind="purchase"), event("", user="a"))
    rows = sorted((r.event_id or "", r.user_id, r.event_type) for r in topic.archive().collect())
    assert rows == [("", "a", "purchase"), ("", "a", "view"), ("", "a", "view"), ("", "b", "view")]
    assert topic.accounts() == [(5, 4, 1, 0)]


def test_an_empty_topic_archives_nothing(topic):
    topic.deliver("")
    assert topic.archive().isEmpty() and topic.accounts() == []


def views(counts):
    return [event(f"{p}-{i}", product=p) for p, n in counts.items() for i in range(n)]


def test_top_products_equal_the_batch_query_whatever_the_summary_holds(topic):
    rng = random.Random(5)
    for part in range(3):
        counts = {f"p{i:03d}": rng.choice([1, 1, 2, 3, 4]) for i in rng.sample(range(120), 70)}
        topic.deliver(*views({**counts, "hot": 120, "warm": 30 + part, None: 9}), event("o", kind="purchase"), "broken")
        topic.count(SummarySize(buckets=2, counters=12))
    for k in (1, 2, 3, 5, 50, 1000):
        assert topic.top(k) == topic.expected(k) != []
    assert topic.top(3)[2][0] is None


def read_summary(topic):
    return topic.spark.read.schema(top.SUMMARY).parquet(f"{topic.out}/summary/batch={top.last_batch(topic.spark, topic.out)}")


def test_the_summary_is_bounded_and_its_bounds_hold(topic):
    rng = random.Random(9)
    true = Counter()
    for _ in range(4):
        counts = {f"p{i}": rng.randrange(1, 6) for i in rng.sample(range(90), 40)}
        true.update(counts)
        topic.deliver(*views(counts))
        topic.count(SummarySize(buckets=3, counters=5))
    held = {r.product_id: r for r in read_summary(topic).collect()}
    assert len(held) == 15 and any(r.error for r in held.values())
    assert all(r.view_count - r.error <= true[p] <= r.view_count for p, r in held.items())
    floors = {r.bucket: r.floor for r in held.values()}
    buckets = dict(topic.spark.createDataFrame([(p,) for p in true], "p string").selectExpr("p", "pmod(xxhash64(p), 3)").collect())
    assert all(true[p] <= floors[buckets[p]] for p in true if p not in held)


def test_proven_candidates_are_the_only_counts_read(topic, plan):
    small = {f"p{i}": 2 for i in range(40)}
    topic.deliver(*views({**small, "a": 50, "b": 40}))
    topic.count(SummarySize(buckets=1, counters=6))
    _, proven, exact = top.candidates(read_summary(topic), 2)
    assert proven and exact and "counts" not in plan(top_products_so_far(topic.spark, topic.out, 2))
    topic.deliver(*views({"c": 60}))  # enters with an error, so that its stored counts must be summed
    topic.count(SummarySize(buckets=1, counters=6))
    possible, proven, exact = top.candidates(read_summary(topic), 2)
    assert proven and not exact and possible.count() == 2
    assert "LeftSemi" in plan(top_products_so_far(topic.spark, topic.out, 2))
    assert topic.top(2) == topic.expected(2) == [("c", 60), ("a", 50)]
    assert not top.candidates(read_summary(topic), 5)[1] and topic.top(5) == topic.expected(5)  # ties with what was dropped: all counts


def test_a_batch_of_counts_that_is_run_again_changes_nothing(topic):
    size = SummarySize(buckets=1, counters=3)
    topic.deliver(*views({"a": 5, "b": 4, "c": 3, "d": 2}))
    topic.count(size)
    topic.deliver(*views({"d": 9, "a": 1}))
    topic.count(size)
    before, commits = topic.top(3), f"{topic.out}/{S.CHECKPOINTS}/top-products/commits"
    for name in ("1", ".1.crc"):  # as if the job had died after its last write and before the commit
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")
    topic.count(size)
    assert topic.top(3) == before == [("d", 11), ("a", 6), ("b", 4)]
    summary = f"{topic.out}/summary/batch=2"
    os.makedirs(summary)  # a batch that has begun to write and is not whole is not read
    assert topic.top(3) == before


def test_no_views_and_no_batches(topic):
    assert topic.top(5) == []
    topic.deliver(event("a", kind="purchase"), "x")
    topic.count(SummarySize())
    assert topic.top(5) == []
