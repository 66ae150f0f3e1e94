from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clicklake import schema as S
from clicklake.operators import traffic as M
from clicklake.sources import sinks


def test_mix_shares_sum_to_one(clicks):
    events = clicks(*[("u", "p", t, "2026-05-11 10:00:00") for t in ("view", "view", "view", "purchase")], ("u", "p", "view", "2026-05-12 00:00:00"))
    mix = {(str(r.bucket), r.event_type): (r.events, r.share) for r in M.event_mix(events, F.col("event_date")).collect()}
    assert mix == {("2026-05-11", "view"): (3, 0.75), ("2026-05-11", "purchase"): (1, 0.25), ("2026-05-12", "view"): (1, 1.0)}


def test_drift_counts_types_missing_on_either_side(clicks):
    events = clicks(("u", "p", "view", "2026-05-11 10:00:00"), ("u", "p", "other", "2026-05-11 10:00:00"))
    drift = {r.event_type: (r.events, r.share, r.expected_share) for r in M.event_mix_drift(events, F.col("event_date"), S.EVENT_MIXES["peak_hour"]).collect()}
    assert drift == {"view": (1, 0.5, 0.6), "other": (1, 0.5, 0.0), "add_to_cart": (0, 0.0, 0.3), "purchase": (0, 0.0, 0.1)}


def test_mixes_are_percentages():
    assert all(sum(mix.values()) == 100 for mix in S.EVENT_MIXES.values())


def test_peak_band_includes_its_edges(clicks):
    events = clicks(*[("u", "p", "view", f"2026-05-11 10:00:{s:02d}") for s in (0, 3, 4, 5, 6, 7, 10)])
    assert {r.band: r.events for r in M.band_activity(events).collect()} == {"peak": 3, "off_peak": 4}


def test_peak_band_of_a_given_range(clicks):
    events = clicks(*[("u", "p", "view", f"2026-05-11 10:00:{s:02d}") for s in (0, 8, 12, 13)])
    given = ("2026-05-11 10:00:00", datetime(2026, 5, 11, 10, 0, 20))
    assert {r.band: r.events for r in M.band_activity(events, time_range=given).collect()} == {"peak": 2, "off_peak": 2}


def test_band_of_one_instant_is_peak(clicks):
    assert [r.band for r in M.band_activity(clicks(("u", "p", "view", "2026-05-11 10:00:00"))).collect()] == ["peak"]


def test_merge_keeps_all_rows_and_fills_missing_columns(spark, clicks):
    web = clicks(("u", "p", "view", "2026-05-11 10:00:01"), ("u", "p", "view", "2026-05-11 10:00:01"))
    app = clicks(("w", "q", "view", "2026-05-11 10:00:00")).drop("category", "product_id").withColumn("device", F.lit("phone"))
    merged = M.merge_feeds({"web": web, "app": app})
    assert sorted((r.feed, r.product_id, r.device) for r in merged.collect() if r.feed == "web") == [("web", "p", None)] * 2
    assert [(r.product_id, r.device) for r in merged.where("feed = 'app'").collect()] == [(None, "phone")]


@pytest.fixture
def many_files(spark):
    """Several files from few rows."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def written(spark, folder):
    """Rows per file, in the order of the files."""
    return [spark.read.parquet(str(f)).collect() for f in sorted(folder.glob("*.parquet"))]


def test_time_ordered_files(spark, clicks, tmp_path, many_files):
    events = clicks(*[("u", "p", "view", f"2026-05-11 10:{i * 7 % 60:02d}:00") for i in range(120)])
    sinks.write_time_ordered(events, str(tmp_path / "out"))
    files = written(spark, tmp_path / "out")
    times = [r.event_time for rows in files for r in rows]
    assert len(files) > 1 and times == sorted(times) and times[0] == datetime(2026, 5, 11, 10) and len(times) == 120


def test_copies_of_one_event_are_spread(spark, clicks, tmp_path, many_files):
    copies = clicks(("u", "p", "view", "2026-05-11 10:30:00")).crossJoin(spark.range(0, 400, 1, 8).select()).repartition(8)
    others = clicks(*[("u", "p", "view", f"2026-05-11 10:{i:02d}:00") for i in range(60)])
    sinks.write_time_ordered(copies.unionByName(others), str(tmp_path / "out"))
    files = written(spark, tmp_path / "out")
    times = [r.event_time for rows in files for r in rows]
    assert times == sorted(times) and len(times) == 460
    assert max(len(rows) for rows in files) < 300
