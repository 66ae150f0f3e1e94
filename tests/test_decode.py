import json
from datetime import date, datetime

from pyspark.sql import functions as F

from clicklake.operators.decode import alertable, archivable, decode_events, with_event_date

GOOD = {
    "event_id": "a", "user_id": 1042, "product_id": "E100", "event_type": "view", "category": "Electronics",
    "timestamp": "2026-05-11T10:00:00.123456",
}


def messages(spark, *documents):
    values = [d if isinstance(d, str) or d is None else json.dumps(d) for d in documents]
    return spark.createDataFrame([(v,) for v in values], "value string").select(F.col("value").cast("binary").alias("value"))


def changed(**fields):
    return {**GOOD, **fields}


def test_good_event_keeps_numbers_as_text_and_parses_the_time(spark):
    row = decode_events(messages(spark, GOOD)).first()
    assert row.user_id == "1042" and row.timestamp == GOOD["timestamp"]
    assert row.event_time == datetime(2026, 5, 11, 10, 0, 0, 123456)


def test_named_fields_only(spark):
    feed = messages(spark, GOOD, "not json")
    assert [r.asDict() for r in decode_events(feed, "category", "event_id").collect()] == [
        {"category": "Electronics", "event_id": "a"}, {"category": None, "event_id": None},
    ]
    assert decode_events(feed, "timestamp").columns == ["timestamp", "event_time"]


def test_unreadable_documents_are_rows_of_nulls(spark):
    rows = decode_events(messages(spark, "not json", '{"event_id": "b", "user', None, "")).collect()
    assert [tuple(r) for r in rows] == [(None,) * 7] * 4


def test_unknown_fields_are_ignored(spark):
    row = decode_events(messages(spark, changed(extra=1))).first()
    assert row.asDict().keys() == GOOD.keys() | {"event_time"} and row.event_id == "a"


def test_time_forms(spark):
    texts = ["bad", "", None, "2026-05-11T10:00:00Z", "2026-05-11T12:00:00+02:00", "2026-05-11", "2026-05-11T10:00:00"]
    rows = decode_events(messages(spark, *[changed(timestamp=t) for t in texts])).collect()
    ten = datetime(2026, 5, 11, 10)
    assert [r.event_time for r in rows] == [None, None, None, ten, ten, datetime(2026, 5, 11), ten]


def test_the_two_validity_rules(spark):
    feed = decode_events(
        messages(
            spark, GOOD, changed(event_id="no product", product_id=None), changed(event_id="no type", event_type=None),
            changed(event_id="no time", timestamp="bad"), "not json",
        )
    )
    assert [r.event_id for r in alertable(feed).collect()] == ["a"]
    assert [r.event_id for r in archivable(feed).collect()] == ["a", "no product", "no type"]


def test_event_date(spark):
    assert with_event_date(decode_events(messages(spark, GOOD))).first().event_date == date(2026, 5, 11)
