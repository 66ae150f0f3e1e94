import json
import os
from datetime import datetime

import pytest

from clicklake import cli
from clicklake.operators.alerts import flash_sale_alerts
from clicklake.operators.decode import alertable, decode_events
from clicklake.session import stream_session
from clicklake.sources import files, kafka
from clicklake.streaming.alerts import alert_rows, alert_writer, start_alerts
from clicklake.streaming.archive import archive_rows, start_archive
from clicklake.streaming.run import wait


def event(product, time, kind="view"):
    fields = {"event_id": f"{product}{time}", "user_id": 1, "product_id": product, "event_type": kind, "category": "A", "timestamp": time}
    return json.dumps(fields)


class Topic:
    """A folder that messages arrive in, and the alert and archive jobs over it."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.batches = spark, folder, 0
        self.topic = folder / "topic"
        self.topic.mkdir()

    def deliver(self, *messages):
        self.batches += 1
        file = self.topic / f"{self.batches:03d}.txt"
        file.write_text("\n".join(messages) + "\n")
        os.utime(file, (1_700_000_000 + self.batches,) * 2)  # the source reads files in order of their time

    def run_alerts(self, sink="parquet"):
        session = stream_session(self.spark, state_partitions=2)
        alerts = alert_rows(files.stream_messages(session, str(self.topic), max_files_per_trigger=1))
        writer = alert_writer(alerts, str(self.folder / f"cp-{sink}"), sink, path=str(self.folder / sink))
        query = start_alerts(writer, every=None)
        wait(query)
        return query

    def alerts(self):
        return self.spark.read.parquet(str(self.folder / "parquet"))

    def run_archive(self):
        wait(start_archive(files.stream_messages(self.spark, str(self.topic)), str(self.folder / "lake"), every=None))
        return files.read_lake(self.spark, str(self.folder / "lake"))


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path)


SIX_VIEWS = [event("P", f"2026-05-11T10:00:0{s}") for s in range(6)]


def test_alert_waits_for_the_watermark_comes_once_and_late_events_are_dropped(topic, rows):
    topic.deliver(*SIX_VIEWS)
    topic.run_alerts()
    assert topic.alerts().count() == 0

    topic.deliver(event("Q", "2026-05-11T10:30:00"))
    topic.run_alerts()
    alerts = topic.alerts().orderBy("start").collect()
    assert [(a.start.hour, a.start.minute) for a in alerts] == [(9, 56), (9, 57), (9, 58), (9, 59), (10, 0)]
    assert {(a.product_id, a.view_count, a.purchase_count) for a in alerts} == {("P", 6, 0)}

    topic.deliver(event("P", "2026-05-11T10:00:30"), event("Q", "2026-05-11T10:31:00"))
    query = topic.run_alerts()
    assert topic.alerts().count() == 5
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert dropped == 5


def test_other_event_types_advance_the_watermark(topic):
    topic.deliver(*SIX_VIEWS)
    topic.deliver(event("Q", "2026-05-11T10:30:00", "add_to_cart"))
    topic.run_alerts()
    assert topic.alerts().count() == 5


def test_stream_equals_batch_on_closed_windows(spark, topic, rows):
    messages = [event("P" if i % 3 == 0 else f"p{i % 5}", f"2026-05-11T10:{i // 5 % 60:02d}:{i % 60:02d}") for i in range(300)]
    for start in range(0, 300, 50):
        topic.deliver(*messages[start : start + 50])
    topic.run_alerts()
    decoded = alertable(decode_events(files.read_messages(spark, str(topic.topic))))
    closed = flash_sale_alerts(decoded).where("end <= timestamp '2026-05-11 10:49:59'")
    assert rows(topic.alerts()) == rows(closed) != []


def test_message_sink_gets_json_documents(spark, topic):
    topic.deliver(*SIX_VIEWS)
    topic.deliver(event("Q", "2026-05-11T10:30:00"))
    topic.run_alerts("text")
    documents = [json.loads(r.value) for r in spark.read.text(str(topic.folder / "text")).collect()]
    assert len(documents) == 5
    assert min(documents, key=lambda d: d["start"]) == {
        "start": "2026-05-11T09:56:00.000Z", "end": "2026-05-11T10:01:00.000Z", "product_id": "P", "view_count": 6,
        "purchase_count": 0, "action": "Flash Sale Recommended",
    }


def test_archive_restarts_without_repeating(topic, rows):
    topic.deliver(*SIX_VIEWS, "not json", event("P", "bad"))
    assert topic.run_archive().count() == 6
    assert topic.run_archive().count() == 6
    topic.deliver(event(None, "2026-05-12T00:00:00"))
    archived = topic.run_archive()
    assert archived.count() == 7
    days = {str(r.event_date) for r in archived.collect()}
    assert days == {"2026-05-11", "2026-05-12"}
    assert (topic.folder / "lake" / "_checkpoints" / "raw-event-archive").is_dir()


def test_processing_time_trigger_and_stop(spark, topic):
    topic.deliver(*SIX_VIEWS)
    query = start_archive(files.stream_messages(spark, str(topic.topic)), str(topic.folder / "lake"), every="1 seconds", name="ticking")
    assert query.name == "ticking" and query.isActive
    query.processAllAvailable()
    assert wait(query, timeout=0.1) is False
    assert not query.isActive
    assert files.read_lake(spark, str(topic.folder / "lake")).count() == 6


def test_failures_are_raised(spark, topic):
    topic.deliver(*SIX_VIEWS)
    broken = archive_rows(files.stream_messages(spark, str(topic.topic))).selectExpr("assert_true(event_id is null) as x")
    query = broken.writeStream.format("noop").option("checkpointLocation", str(topic.folder / "cp")).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="assert_true|is not true|USER_RAISED"):
        wait(query)


def test_state_settings_stay_in_the_stream_session(spark):
    session = stream_session(spark, state_partitions=3)
    assert "RocksDB" in session.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert session.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_a_backfill_starts_at_the_beginning_and_alerts_go_in_bounded_batches():
    from clicklake import cli

    def options(*args):
        return cli._topic_options(cli._parser().parse_args(args))

    archive, alerts = ["archive", "--servers", "b", "--lake", "l"], ["alerts", "--servers", "b", "--checkpoint", "c"]
    assert options(*archive)["startingOffsets"] == "latest" and options(*archive)["failOnDataLoss"] == "true"
    assert options(*archive, "--backfill", "--allow-data-loss")["startingOffsets"] == "earliest"
    assert options(*archive, "--backfill", "--allow-data-loss")["failOnDataLoss"] == "false"
    assert options(*alerts, "--backfill", "--starting-offsets", "latest")["startingOffsets"] == "latest"
    assert options(*alerts, "--backfill")["maxOffsetsPerTrigger"] == str(cli.BACKFILL_OFFSETS)
    assert "maxOffsetsPerTrigger" not in options(*alerts)


def test_kafka_options():
    assert kafka.source_options("b:9092", "clicks") == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "clicks", "startingOffsets": "latest", "failOnDataLoss": "true",
    }
    assert kafka.source_options("b", "t", max_offsets_per_trigger=5, min_partitions=64)["minPartitions"] == "64"
    assert kafka.sink_options("b", "alerts", "/cp") == {
        "kafka.bootstrap.servers": "b", "topic": "alerts", "checkpointLocation": "/cp",
    }


def test_messages_are_json(spark):
    rows = kafka.as_messages(spark.createDataFrame([(datetime(2026, 5, 11, 10), "p", 1)], "start timestamp, product_id string, n int"))
    assert rows.collect()[0].value == '{"start":"2026-05-11T10:00:00.000Z","product_id":"p","n":1}'


def test_command_line():
    args = cli._parser().parse_args(["alerts", "--servers", "b", "--checkpoint", "/cp", "--state-partitions", "400"])
    assert (args.topic, args.alerts_topic, args.every, args.min_views) == ("clickstream-events", "alerts-notifications", "30 seconds", 5)
    assert cli._parser().parse_args(["archive", "--servers", "b", "--lake", "/l"]).every == "120 seconds"
    with pytest.raises(SystemExit):
        cli._parser().parse_args(["daily", "--lake", "/l"])
