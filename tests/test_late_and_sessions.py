"""Late events, sessions on a stream and distinct counts over ranges of days: restarts, skew and odd rows."""

import json
import os
import shutil
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from clicklake import schema as S
from clicklake.operators.decode import decode_events
from clicklake.operators.sessions import user_sessions
from clicklake.plans.distinct import daily_sketches, read_sketches, relative_error, statistics_over
from clicklake.session import stream_session
from clicklake.sources import files, sinks
from clicklake.streaming.late import missed_windows, read_late_events, start_late_events
from clicklake.streaming.run import wait
from clicklake.streaming.sessions import closed_sessions, start_sessions


def event(user, time, i=0):
    return json.dumps({"event_id": f"{user}-{time}-{i}", "user_id": user, "product_id": "p", "event_type": "view", "category": "A", "timestamp": time})


class Topic:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.topic, self.parts = spark, folder, folder / "topic", 0
        self.topic.mkdir()

    def deliver(self, *messages):
        self.parts += 1
        (self.topic / f"{self.parts:03d}.txt").write_text("\n".join(messages) + "\n")

    def late(self):
        wait(start_late_events(files.stream_messages(self.spark, str(self.topic)), str(self.folder / "out"), every=None))
        return read_late_events(self.spark, str(self.folder / "out"))

    def sessions(self, gap=300):
        session = stream_session(self.spark, state_partitions=2)
        closed = closed_sessions(files.stream_messages(session, str(self.topic)), gap)
        wait(start_sessions(closed, str(self.folder / "sessions"), str(self.folder / "cp"), every=None))
        return self.spark.read.parquet(str(self.folder / "sessions")).select("user_id", "session_start", "last_event", "events", "duration_seconds")


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path)


def test_late_events_are_kept_with_what_they_missed(topic):
    topic.deliver(event("a", "2026-05-11T10:00:00"), event("a", "2026-05-11T09:00:00"), event("a", "bad"), "not json")
    assert topic.late().count() == 0  # nothing is late in the first batch
    topic.deliver(event("b", "2026-05-11T09:50:00"), event("b", "2026-05-11T09:49:59"), event("b", "2026-05-11T09:00:30"), event("b", "2026-05-11T10:30:00"))
    rows = topic.late().orderBy("event_time").collect()
    assert [(r.event_time.minute, r.behind_seconds, r.missed_windows, r.batch) for r in rows] == [(0, 2970.0, 5, 1), (49, 1.0, 1, 1)]
    topic.deliver(event("c", "2026-05-11T10:19:00"))
    assert topic.late().where("batch = 2").collect()[0].behind_seconds == 60.0


def test_missed_windows_equal_the_windows_that_have_ended(spark):
    rule = S.AlertRule(window_seconds=250, slide_seconds=60)
    base = datetime(2026, 5, 11, 10)
    marks = [(base.replace(minute=m // 60, second=m % 60), base.replace(minute=k // 60, second=k % 60)) for m in range(0, 300, 17) for k in range(0, 900, 23)]
    frame = spark.createDataFrame(marks, "at timestamp, mark timestamp").withColumn("found", missed_windows("at", F.col("mark"), rule))
    windows = frame.withColumn("w", F.window("at", rule.window, rule.slide))
    plain = windows.groupBy("at", "mark", "found").agg(F.count_if(F.col("w.end") <= F.col("mark")).alias("ended"))
    assert plain.where("found != ended").isEmpty() and plain.where("found > 2").count()


def test_a_batch_of_late_events_that_is_run_again_changes_nothing(topic, rows):
    topic.deliver(event("a", "2026-05-11T10:00:00"))
    topic.late()
    topic.deliver(*[event("b", f"2026-05-11T09:0{i}:00") for i in range(6)], event("b", "2026-05-11T11:00:00"))
    before = rows(topic.late())
    commits = topic.folder / "out" / S.CHECKPOINTS / "late-events" / "commits"
    for name in ("1", ".1.crc"):  # as if the job had died after its last write and before the commit
        if (commits / name).exists():
            os.remove(commits / name)
    assert rows(topic.late()) == before and len(before) == 6
    topic.deliver(event("c", "2026-05-11T10:49:00"))
    assert topic.late().where("batch = 2").count() == 1


def test_sessions_grow_and_merge_over_restarts_and_leave_once(spark, topic, rows):
    topic.deliver(event("a", "2026-05-11T10:00:00"), event("a", "2026-05-11T10:08:00"), event(None, "2026-05-11T10:00:00"))
    assert topic.sessions().count() == 0
    topic.deliver(event("a", "2026-05-11T10:04:00"), event("a", "2026-05-11T10:13:00"), event("b", "2026-05-11T10:00:00"), event("b", "2026-05-11T10:05:00.000001"))
    topic.sessions()
    topic.deliver(*[event("hot", f"2026-05-11T12:00:{i % 60:02d}", i) for i in range(500)])
    assert len(rows(topic.sessions())) == len(rows(topic.sessions()))
    messages = files.read_messages(spark, str(topic.topic))
    expected = user_sessions(decode_events(messages).where("event_time is not null")).where("last_event < timestamp '2026-05-11 11:45:00'")
    found = rows(topic.sessions())
    assert found == rows(expected.select("user_id", "session_start", "last_event", "events", "duration_seconds"))
    assert [r[3] for r in found if r[0] == "a"] == [4] and sorted(r[3] for r in found if r[0] == "b") == [1, 1]


def test_stream_sessions_equal_batch_sessions_on_random_events(spark, topic, rows):
    import random

    rng = random.Random(7)
    events = sorted((rng.randrange(0, 80_000), rng.choice("aaaabcd")) for _ in range(600))
    texts = [event(u, f"2026-05-11T{s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}", i) for i, (s, u) in enumerate(events)]
    for k in range(0, 600, 200):
        topic.deliver(*texts[k : k + 200])
        topic.sessions(gap=240)
    mark = datetime(2026, 5, 11) .timestamp() + events[-1][0] - 600
    batch = user_sessions(decode_events(files.read_messages(spark, str(topic.topic))), 240)
    closed = batch.where(F.unix_timestamp("last_event") + 240 < F.lit(mark))
    found = rows(topic.sessions(gap=240))
    assert found == rows(closed.select("user_id", "session_start", "last_event", "events", "duration_seconds")) != []


def counts_and_users(spark, days):
    counts = [(date(2026, 5, d), f"p{i}", 3) for d, (products, _) in days.items() for i in range(products)] + [(date(2026, 5, 1), None, 5)]
    users = [(date(2026, 5, d), f"u{i + 40 * d}") for d, (_, people) in days.items() for i in range(people)] + [(date(2026, 5, 1), None)]
    return spark.createDataFrame(counts, "report_date date, product_id string, events bigint"), spark.createDataFrame(users, "report_date date, user_id string")


DAYS = {1: (4, 30), 2: (5000, 300), 3: (20, 4000), 7: (1, 1)}


def test_ranges_are_united_from_daily_sketches(spark, tmp_path, plan):
    counts, users = counts_and_users(spark, DAYS)
    path = str(tmp_path / "sketches")
    sinks.write_table(daily_sketches(counts, users), path)
    ranges = [("2026-05-01", "2026-5-7"), (date(2026, 5, 2), date(2026, 5, 3)), ("2026-05-04", "2026-05-06"), ("2026-05-07", "2026-05-01")]
    found = {(str(r.first_day)[-1], str(r.last_day)[-1]): r for r in statistics_over(read_sketches(spark, path), [*ranges, ranges[0]]).collect()}
    assert len(found) == 4
    for (a, b), r in found.items():
        inside = f"day(report_date) between {a} and {b}"
        assert r.records_processed == (counts.where(inside).agg(F.sum("events")).first()[0] or 0)
        for estimate, frame, column in ((r.unique_products, counts, "product_id"), (r.unique_users, users, "user_id")):
            exact = frame.where(inside).agg(F.count_distinct(column)).first()[0]
            assert abs(estimate - exact) <= relative_error() * exact
    assert found["4", "6"].days == found["7", "1"].days == 0 and found["1", "7"].days == 4


def test_a_rerun_day_replaces_its_sketch(spark, tmp_path):
    path = str(tmp_path / "sketches")
    sinks.write_table(daily_sketches(*counts_and_users(spark, DAYS)), path)
    sinks.write_table(daily_sketches(*counts_and_users(spark, {2: (10, 10)})).where("report_date = '2026-05-02'"), path)
    row = statistics_over(read_sketches(spark, path), [("2026-05-02", "2026-05-02")]).first()
    assert (row.records_processed, row.unique_products, row.unique_users) == (30, 10, 10)
    shutil.rmtree(path)
