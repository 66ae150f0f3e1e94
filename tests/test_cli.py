"""Jobs by their command lines, on the session of the tests."""

import json

import pytest

from clicklake import cli
from clicklake.plans.daily import ReportPaths
from clicklake.sources import files
from clicklake.streaming.totals import daily_user_totals


@pytest.fixture
def run(spark, monkeypatch):
    monkeypatch.setattr(cli, "build_session", lambda name: spark)
    return lambda *arguments: cli.main([str(a) for a in arguments])


def message(user, kind, time="2026-05-11T10:00:00"):
    return json.dumps({"event_id": "1", "user_id": user, "product_id": "p", "event_type": kind, "category": "A", "timestamp": time})


@pytest.mark.parametrize(("options", "users"), [((), "string"), (("--schema", "user_id bigint, product_id string, event_type string"), "bigint")])
def test_the_batch_job_takes_the_types_of_the_events(spark, run, tmp_path, options, users):
    (tmp_path / "in").mkdir()
    text = [json.dumps({"user_id": 7 if options else "7", "product_id": "p", "event_type": kind}) for kind in ("view", "purchase")]
    (tmp_path / "in" / "a.json").write_text("\n".join(text))
    run("batch", "--input", tmp_path / "in", "--reports", tmp_path / "out", "--report-date", "2026-5-11", *options)
    found = spark.read.json(ReportPaths(str(tmp_path / "out")).of("batch_user_segments"))
    assert dict(found.dtypes)["user_id"] == users and [(int(r.user_id), r.views, r.purchases) for r in found.collect()] == [(7, 1, 1)]


def test_the_totals_job(spark, run, monkeypatch, tmp_path):
    (tmp_path / "topic").mkdir()
    (tmp_path / "topic" / "1.txt").write_text("\n".join([message("a", "view"), message("a", "purchase"), "not json"]))
    asked = []
    monkeypatch.setattr(cli.kafka, "read_topic", lambda session, options: asked.append(options) or files.stream_messages(session, str(tmp_path / "topic")))
    run("totals", "--servers", "h:1", "--root", tmp_path / "totals", "--backfill")
    assert [tuple(r)[1:] for r in daily_user_totals(spark, str(tmp_path / "totals")).collect()] == [("a", 1, 1)]
    assert asked[0]["startingOffsets"] == "earliest"


def test_a_job_must_be_named(run):
    with pytest.raises(SystemExit):
        run("nothing")
