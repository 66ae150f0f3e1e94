"""One query per operator, over the whole supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clicklake import schema as S
from clicklake.operators import activity as A
from clicklake.operators import conversion as C
from clicklake.operators import decode as D
from clicklake.operators import products as P
from clicklake.operators import quality as Q
from clicklake.operators import reports as R
from clicklake.operators import segments as G
from clicklake.operators import sessions as N
from clicklake.operators import traffic as M
from clicklake.operators.alerts import flash_sale_alerts as detect
from clicklake.operators.validity import enrich_category_as_of as as_of
from clicklake.plans.batch import write_batch_reports
from clicklake.plans.daily import write_daily_reports
from clicklake.plans.distinct import read_sketches, relative_error, statistics_over
from clicklake.session import scratch_dir, stream_session
from clicklake.sources import files, inventory, sinks
from clicklake.streaming.alerts import alert_rows, alert_writer, start_alerts
from clicklake.streaming.archive import start_archive
from clicklake.streaming.audit import open_windows
from clicklake.streaming.late import read_late_events, start_late_events
from clicklake.streaming.once import read_accounts, start_archive_once, wait_and_account
from clicklake.streaming.order import order_violations_so_far, start_order_check
from clicklake.streaming.run import wait
from clicklake.streaming.sessions import closed_sessions, start_sessions
from clicklake.streaming.top import SummarySize, start_top_products, top_products_so_far
from clicklake.streaming.totals import daily_category_totals, daily_user_totals, start_daily_totals
from workload import feeds

Query = Callable[[SparkSession, str], DataFrame]

# Settings that give results on the supplied tables, where a user makes a few events a day.
MIN_VIEWS = 2
GAP_SECONDS = 6 * 3600
RULE = S.AlertRule(window_seconds=6 * 3600, slide_seconds=3600, min_views=2, purchases_below=3)
CALENDAR = ("2023-12-25", "2024-02-05")
SLICE = ("2024-01-10", "2024-01-12")
RANGES = [("2024-01-01", "2024-01-31"), ("2024-1-3", "2024-1-9"), SLICE, ("2024-01-11", "2024-01-11"), ("2031-01-01", "2031-01-05")]
REPEAT_DELAY = "8 days"
SUMMARY_SIZE = SummarySize(buckets=4, counters=20)

_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _decoded(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    return D.decode_events(files.read_messages(spark, feeds.topic(spark, sf_dir)), *fields)


# --- decode -----------------------------------------------------------------------------------------------------------


@_query
def decode_events(spark, sf_dir):
    return _decoded(spark, sf_dir)


@_query
def decode_valid_for_alerts(spark, sf_dir):
    return D.alertable(_decoded(spark, sf_dir))


@_query
def decode_valid_for_archive(spark, sf_dir):
    return D.with_event_date(D.archivable(_decoded(spark, sf_dir)))


# --- counts, segments, conversion, ranks ------------------------------------------------------------------------------


@_query
def product_view_counts(spark, sf_dir):
    return A.product_view_counts(feeds.click_events(spark, sf_dir))


@_query
def user_activity(spark, sf_dir):
    return A.user_activity(feeds.click_events(spark, sf_dir))


@_query
def daily_user_activity(spark, sf_dir):
    return A.daily_user_activity(feeds.click_events(spark, sf_dir))


@_query
def user_segments_3way(spark, sf_dir):
    return G.segments_three_way(user_activity(spark, sf_dir))


@_query
def daily_user_segments_3way(spark, sf_dir):
    return G.segments_three_way(daily_user_activity(spark, sf_dir), MIN_VIEWS)


@_query
def daily_user_segments_3way_default(spark, sf_dir):
    return G.segments_three_way(daily_user_activity(spark, sf_dir))


@_query
def daily_user_segments_2way(spark, sf_dir):
    return G.segments_two_way(daily_user_activity(spark, sf_dir))


@_query
def segment_distribution(spark, sf_dir):
    return G.segment_distribution(daily_user_segments_3way(spark, sf_dir), "event_date")


@_query
def segment_distribution_2way(spark, sf_dir):
    return G.segment_distribution(daily_user_segments_2way(spark, sf_dir), "event_date")


@_query
def daily_run_statistics(spark, sf_dir):
    return A.run_statistics(files.read_lake(spark, feeds.lake(spark, sf_dir)), "event_date")


@_query
def category_conversion(spark, sf_dir):
    return C.category_conversion(_decoded(spark, sf_dir, "event_type", "category"))


@_query
def daily_category_conversion(spark, sf_dir):
    return C.category_conversion(files.read_lake(spark, feeds.lake(spark, sf_dir)), "event_date")


@_query
def catalogue_conversion(spark, sf_dir):
    return C.catalogue_conversion(feeds.click_events(spark, sf_dir), feeds.stocked(spark, sf_dir))


@_query
def duplicate_catalogue_conversion(spark, sf_dir):
    """With a catalogue that lists products twice, in another category or an empty one."""
    parts = feeds.catalogue(spark, sf_dir).select("product_id", "category")
    again = parts.select("product_id", F.when(F.length("category") % 2 == 0, "").otherwise(F.reverse("category")).alias("category"))
    return C.catalogue_conversion(feeds.click_events(spark, sf_dir), parts.unionByName(again))


@_query
def daily_catalogue_conversion(spark, sf_dir):
    return C.catalogue_conversion(feeds.click_events(spark, sf_dir), feeds.catalogue(spark, sf_dir), "event_date")


@_query
def run_statistics(spark, sf_dir):
    return A.run_statistics(_decoded(spark, sf_dir, "user_id", "product_id"))


@_query
def top_products(spark, sf_dir):
    return P.top_products(feeds.click_events(spark, sf_dir))


@_query
def daily_top_products(spark, sf_dir):
    return P.daily_top_products(feeds.click_events(spark, sf_dir))


@_query
def category_conversion_ranked(spark, sf_dir):
    return C.ranked_by_rate(daily_catalogue_conversion(spark, sf_dir))


@_query
def category_conversion_ordered(spark, sf_dir):
    return C.ordered_by_rate(catalogue_conversion(spark, sf_dir))


# --- report text ------------------------------------------------------------------------------------------------------


@_query
def segment_summary_lines(spark, sf_dir):
    return R.segment_summary_lines(segment_distribution(spark, sf_dir))


def _daily_product_counts(spark, sf_dir):
    return A.activity(feeds.click_events(spark, sf_dir), "event_date", "product_id")


@_query
def top_products_report(spark, sf_dir):
    return R.top_products_lines(_daily_product_counts(spark, sf_dir))


@_query
def conversion_report(spark, sf_dir):
    """Over the archived events, where some categories are missing or empty."""
    return R.conversion_lines(daily_category_conversion(spark, sf_dir))


@_query
def daily_report_body(spark, sf_dir):
    rates = R.conversion_lines(daily_catalogue_conversion(spark, sf_dir))
    return R.daily_report_body(top_products_report(spark, sf_dir), rates, "/lake/reports")


# --- alerts and streams -----------------------------------------------------------------------------------------------


@_query
def flash_sale_alerts(spark, sf_dir):
    return detect(feeds.click_events(spark, sf_dir), RULE)


def _alert_stream(spark: SparkSession, sf_dir: str, sink: str) -> str:
    topic = feeds.topic(spark, sf_dir)
    out = scratch_dir(spark, "alerts")
    session = stream_session(spark, state_partitions=spark.sparkContext.defaultParallelism)
    alerts = alert_rows(files.stream_messages(session, topic), RULE)
    wait(start_alerts(alert_writer(alerts, f"{out}/checkpoint", sink, path=f"{out}/alerts"), every=None))
    return out


@_query
def flash_sale_stream(spark, sf_dir):
    return spark.read.schema(
        "start timestamp, end timestamp, product_id string, view_count bigint, purchase_count bigint, action string"
    ).parquet(f"{_alert_stream(spark, sf_dir, 'parquet')}/alerts")


@_query
def open_alert_windows(spark, sf_dir):
    """The windows that the alert stream has counted and not yet judged when it stops, from its checkpoint."""
    return open_windows(spark, f"{_alert_stream(spark, sf_dir, 'parquet')}/checkpoint")


@_query
def alert_messages(spark, sf_dir):
    """The alert stream as the JSON documents a message sink gets."""
    return spark.read.text(f"{_alert_stream(spark, sf_dir, 'text')}/alerts")


@_query
def archive_stream(spark, sf_dir):
    topic = feeds.topic(spark, sf_dir)
    root = scratch_dir(spark, "archive")
    wait(start_archive(files.stream_messages(spark, topic), root, every=None))
    return files.read_lake(spark, root)


def _arrive(spark: SparkSession, parts: list[DataFrame], run: Callable[[str], object]) -> None:
    """Let the parts of a feed arrive in a topic folder, and the job, restarted for each, read what is new."""
    topic = scratch_dir(spark, "arrivals")
    for part in parts:
        part.write.mode("append").text(topic)
        run(topic)


@_query
def late_events(spark, sf_dir):
    """Purchases that come a week late, found by a job that is restarted for every part of the feed."""
    root = scratch_dir(spark, "late")
    _arrive(spark, feeds.arrivals(spark, sf_dir, late=True), lambda topic: wait(start_late_events(files.stream_messages(spark, topic), root, every=None, rule=RULE)))
    columns = ["event_id", "user_id", "product_id", "event_type", "event_time", "behind_seconds", "missed_windows", "batch"]
    return read_late_events(spark, root).select(*columns)


@_query
def session_stream(spark, sf_dir):
    """Sessions closed by the watermark, over a feed that arrives in weeks and a job that is restarted for each."""
    out = scratch_dir(spark, "sessions")
    session = stream_session(spark, state_partitions=spark.sparkContext.defaultParallelism)

    def run(topic: str) -> None:
        closed = closed_sessions(files.stream_messages(session, topic), GAP_SECONDS, user_type="bigint")
        wait(start_sessions(closed, f"{out}/sessions", f"{out}/checkpoint", every=None))

    _arrive(spark, feeds.arrivals(spark, sf_dir, late=False), run)
    schema = "user_id bigint, session_start timestamp, last_event timestamp, events bigint, duration_seconds double"
    return spark.read.schema(schema).parquet(f"{out}/sessions")


def _archive_once(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_dir(spark, "once")
    session = stream_session(spark, state_partitions=spark.sparkContext.defaultParallelism)

    def run(topic: str) -> None:
        query = start_archive_once(files.stream_messages(session, topic), root, every=None, delay=REPEAT_DELAY)
        wait_and_account(spark, query, f"{root}/accounts")

    _arrive(spark, feeds.deliveries(spark, sf_dir), run)
    return root


@_query
def archive_once(spark, sf_dir):
    """A lake that holds each event once, from a feed that delivers some of them again and a job that is restarted for each part of it."""
    return files.read_lake(spark, _archive_once(spark, sf_dir)).select("event_id", "user_id", "product_id", "event_type", "event_time", "event_date")


@_query
def archive_once_accounts(spark, sf_dir):
    """What that job was given, archived, and left out as copies or as behind the watermark."""
    found = read_accounts(spark, f"{_archive_once(spark, sf_dir)}/accounts")
    return found.agg(*[F.sum(c).alias(c) for c in ("delivered", "archived", "copies", "behind")])


@_query
def top_products_stream(spark, sf_dir):
    """The top products of a stream that is restarted for every week of its feed, from its bounded summary and the candidates' counts."""
    root = scratch_dir(spark, "top")
    _arrive(
        spark,
        feeds.arrivals(spark, sf_dir, late=False),
        lambda topic: wait(start_top_products(files.stream_messages(spark, topic), root, every=None, size=SUMMARY_SIZE)),
    )
    return top_products_so_far(spark, root)


def _daily_totals(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_dir(spark, "totals")
    _arrive(spark, feeds.labelled_arrivals(spark, sf_dir), lambda topic: wait(start_daily_totals(files.stream_messages(spark, topic), root, every=None)))
    return root


@_query
def user_totals_stream(spark, sf_dir):
    """Daily user activity kept up to date by a stream whose purchases partly come a week late, restarted for every part of the feed."""
    totals = daily_user_totals(spark, _daily_totals(spark, sf_dir))
    return totals.withColumn("user_id", F.col("user_id").cast("bigint"))


@_query
def category_totals_stream(spark, sf_dir):
    """Daily conversion by category, from the same job."""
    return daily_category_totals(spark, _daily_totals(spark, sf_dir))


@_query
def order_violations_stream(spark, sf_dir):
    """``dq_order_violations`` from a stream that is restarted for every quarter of the arrivals."""
    root = scratch_dir(spark, "order")

    def run(topic: str) -> None:
        events = D.decode_events(files.stream_messages(spark, topic), "event_id", "user_id", "timestamp")
        wait(start_order_check(events, root, every=None, keep_seconds=60 * 86_400, chunk=50_000))

    _arrive(spark, feeds.by_arrival(spark, sf_dir), run)
    return order_violations_so_far(spark, root).withColumn("user_id", F.col("user_id").cast("bigint"))


@_query
def statistics_of_ranges(spark, sf_dir):
    """Distinct counts of ranges of days from the daily run's sketches, each held against the exact count of the events."""
    lake, root = feeds.lake(spark, sf_dir), scratch_dir(spark, "ranges")
    paths = write_daily_reports(spark, lake, *CALENDAR, report_root=root)
    estimated = statistics_over(read_sketches(spark, paths.of("daily_sketches")), RANGES)
    asked = estimated.select("first_day", "last_day", F.explode(F.sequence("first_day", "last_day")).alias("event_date"))
    exact = files.read_lake(spark, lake).join(asked, "event_date")
    exact = exact.groupBy("first_day", "last_day").agg(F.count_distinct("product_id").alias("products"), F.count_distinct("user_id").alias("users"))
    both = estimated.join(exact, ["first_day", "last_day"], "left").na.fill(0, ["products", "users"])

    def close(estimate: str, count: str):
        return (F.abs(F.col(estimate) - F.col(count)) <= F.lit(relative_error()) * F.col(count)).alias(f"{count}_close")

    shown = ["first_day", "last_day", "days", "records_processed", "products", "users"]
    return both.select(*shown, close("unique_products", "products"), close("unique_users", "users"))


# --- sources and sinks ------------------------------------------------------------------------------------------------


@_query
def lake_day_slice(spark, sf_dir):
    return files.read_lake(spark, feeds.lake(spark, sf_dir), *SLICE)


@_query
def lake_date_forms(spark, sf_dir):
    """The slice, its bounds given in each form a caller may use: rows per form and day."""
    root, (first, last) = feeds.lake(spark, sf_dir), (date.fromisoformat(d) for d in SLICE)
    forms = {
        "text": SLICE,
        "unpadded": tuple(f"{d.year}-{d.month}-{d.day}" for d in (first, last)),
        "date": (first, last),
        "datetime": (datetime(first.year, first.month, first.day, 23, 59), f"{last}T00:00:00"),
    }
    slices = [files.read_lake(spark, root, *bounds).select(F.lit(form).alias("form"), "event_date") for form, bounds in forms.items()]
    return reduce(DataFrame.unionByName, slices).groupBy("form", "event_date").agg(F.count("*").alias("events"))


@_query
def partition_metadata(spark, sf_dir):
    """Over a lake of text lines, whose sizes are a function of the data."""
    root = scratch_dir(spark, "text-lake")
    line = F.concat("event_type", F.lit(":"), F.repeat("props", 400)).alias("line")
    events = feeds.table(spark, sf_dir, "events").select("event_type", "props", F.to_date("ts").alias("event_date"))
    sinks.write_table(events, files.lake_path(root), "text", day="event_date", finish=lambda rows: rows.select(line, "event_date"))
    known = inventory.partition_metadata(spark, root, "*.txt")
    return known.select(
        "event_date", "total_size_mb", (F.col("file_count") >= 1).alias("has_files"), F.col("last_modified").isNotNull().alias("is_dated")
    )


@_query
def partition_presence(spark, sf_dir):
    known = inventory.partition_metadata(spark, feeds.lake(spark, sf_dir))
    return inventory.partition_presence(known, *CALENDAR).select("event_date", "partition", "exists")


def _dated(rows: DataFrame) -> DataFrame:
    return rows.withColumnRenamed("event_date", sinks.DAY)


@_query
def json_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "json")
    sinks.write_table(_dated(daily_user_segments_3way(spark, sf_dir)), path, "json")
    return files.read_json_events(
        spark, path, "user_id bigint, views bigint, purchases bigint, segment string, report_date date"
    )


@_query
def json_directory_top_products(spark, sf_dir):
    """The plain batch job: a JSON directory straight to the top products."""
    return P.top_products(files.read_json_events(spark, feeds.topic(spark, sf_dir)))


@_query
def csv_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    sinks.write_csv_report(_dated(daily_top_products(spark, sf_dir)), path, "rank")
    columns = "product_id string, view_count bigint, rank int, report_date date"
    return spark.read.schema(columns).csv(path, header=True)


@_query
def text_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "text")
    sinks.write_text_report(top_products_report(spark, sf_dir), path)
    return spark.read.schema("value string, report_date date").text(path).withColumnRenamed("value", "line")


@_query
def segments_rerun(spark, sf_dir):
    """All days written, then some of them again: the rerun replaces its days and leaves the others."""
    path = scratch_dir(spark, "segments")
    segments = _dated(daily_user_segments_2way(spark, sf_dir))
    sinks.write_table(segments, path)
    sinks.write_table(segments.where(F.col(sinks.DAY).between(*SLICE)), path)
    return spark.read.schema(segments.schema).parquet(path)


@_query
def daily_reports(spark, sf_dir):
    """The whole daily run over the lake; its text reports read back."""
    root = scratch_dir(spark, "daily")
    paths = write_daily_reports(spark, feeds.lake(spark, sf_dir), *CALENDAR, report_root=root, min_views=MIN_VIEWS)
    names = ("segment_summary", "top_products_text", "category_conversion_text")
    texts = {n: spark.read.schema("value string, report_date date").text(paths.of(n)) for n in names}
    return M.merge_feeds(texts).select(F.col("feed").alias("report"), "report_date", F.col("value").alias("line"))


def _shrunk_lake(spark, sf_dir, root: str) -> str:
    """The lake without its views on a day, and without any event on the next."""
    events = files.read_lake(spark, feeds.lake(spark, sf_dir))
    day, gone = (F.lit(d).cast("date") for d in SLICE)
    kept = events.where((F.col("event_date") != gone) & ~((F.col("event_date") == day) & (F.col("event_type") == S.VIEW)))
    sinks.write_table(kept, files.lake_path(root), day="event_date")
    return root


def _top_rows(spark, paths):
    return paths.read(spark, "top_products_json", "json", "product_id string, view_count bigint, rank int, report_date date")


@_query
def daily_rerun_shrunk(spark, sf_dir):
    """The daily run, and again on a lake that has lost a day and a day's views: nothing of them may be left."""
    root = scratch_dir(spark, "daily")
    write_daily_reports(spark, feeds.lake(spark, sf_dir), *CALENDAR, report_root=root)
    paths = write_daily_reports(spark, _shrunk_lake(spark, sf_dir, scratch_dir(spark, "shrunk")), *CALENDAR, report_root=root)
    return _top_rows(spark, paths)


@_query
def daily_empty_range(spark, sf_dir):
    """Days after the last event: reports without rows."""
    paths = write_daily_reports(spark, feeds.lake(spark, sf_dir), "2031-01-01", "2031-01-31", report_root=scratch_dir(spark, "daily"))
    return _top_rows(spark, paths)


@_query
def batch_reports(spark, sf_dir):
    """The plain batch run over a JSON directory; its user segments read back."""
    root = scratch_dir(spark, "batch")
    paths = write_batch_reports(spark, feeds.topic(spark, sf_dir), root, "2024-02-01")
    columns = "user_id string, views bigint, purchases bigint, segment string, report_date date"
    return spark.read.schema(columns).json(paths.of("batch_user_segments"))


# --- traffic and sessions ---------------------------------------------------------------------------------------------


@_query
def enrich_category(spark, sf_dir):
    stocked = feeds.without_oversized(feeds.used_catalogue(spark, sf_dir))
    labelled = C.enrich_category(feeds.click_events(spark, sf_dir), stocked)
    return labelled.select("event_id", "product_id", "category")


@_query
def enrich_category_as_of(spark, sf_dir):
    """Over a catalogue in which each product is renamed once, and large ones leave it six days later."""
    labelled = as_of(feeds.click_events(spark, sf_dir), feeds.dated_catalogue(spark, sf_dir))
    return labelled.select("event_id", "product_id", "category")


@_query
def user_sessions(spark, sf_dir):
    return N.user_sessions(feeds.click_events(spark, sf_dir), GAP_SECONDS)


@_query
def session_outcomes(spark, sf_dir):
    return N.session_outcomes(feeds.click_events(spark, sf_dir), GAP_SECONDS, cart_type="click")


@_query
def session_outcomes_ties(spark, sf_dir):
    """Over events whose times are cut to six hours, so that many share an instant."""
    events = feeds.click_events(spark, sf_dir)
    hour = F.timestamp_seconds(F.floor(F.unix_timestamp(F.col("event_time").cast("timestamp")) / 21600) * 21600)
    return N.session_outcomes(events.withColumn("event_time", hour), GAP_SECONDS, cart_type="click")


@_query
def event_mix(spark, sf_dir):
    return M.event_mix(feeds.click_events(spark, sf_dir), F.date_trunc("hour", "event_time"))


@_query
def event_mix_drift(spark, sf_dir):
    return M.event_mix_drift(feeds.click_events(spark, sf_dir), F.col("event_date"), S.EVENT_MIXES["normal"])


@_query
def band_activity(spark, sf_dir):
    return M.band_activity(feeds.click_events(spark, sf_dir))


@_query
def band_activity_null_times(spark, sf_dir):
    """Sign-ups have no time here and are in no band."""
    events = feeds.click_events(spark, sf_dir)
    return M.band_activity(events.withColumn("event_time", F.when(F.col("event_type") != "signup", F.col("event_time"))))


def _feeds(spark, sf_dir):
    events = feeds.click_events(spark, sf_dir)
    shop = events.where(F.col("event_type").isin("view", "click", "purchase"))
    account = events.where(F.col("event_type") == "signup").drop("product_id")
    faults = events.where(F.col("event_type") == "error").drop("product_id", "user_id")
    return M.merge_feeds({"shop": shop, "account": account, "faults": faults})


@_query
def merge_feeds(spark, sf_dir):
    return _feeds(spark, sf_dir).select("feed", "event_id", "event_time", "user_id", "event_type", "product_id")


@_query
def time_ordered_feed(spark, sf_dir):
    """The merged feed as its time-ordered sink writes it; ``time_order_inversions`` checks the order."""
    path = scratch_dir(spark, "ordered")
    merged = merge_feeds(spark, sf_dir)
    sinks.write_time_ordered(merged, path)
    return spark.read.schema(merged.schema).parquet(path)


@_query
def time_order_inversions(spark, sf_dir):
    """Per feed, the rows of the time-ordered files that lie before the row ahead of them in their file: none."""
    placed = time_ordered_feed(spark, sf_dir).select("feed", "event_time", "event_id", "_metadata.file_name", "_metadata.row_index")
    ahead = F.lag(F.struct("event_time", "event_id")).over(Window.partitionBy("file_name").orderBy("row_index"))
    inverted = F.coalesce(F.struct("event_time", "event_id") < ahead, F.lit(False))
    return placed.withColumn("inverted", inverted).groupBy("feed").agg(F.count("*").alias("events"), F.count_if("inverted").alias("inversions"))


# --- data quality -----------------------------------------------------------------------------------------------------


@_query
def dq_missing_fields(spark, sf_dir):
    return Q.missing_fields(_decoded(spark, sf_dir), S.EVENT_SCHEMA.fieldNames())


@_query
def dq_rule_counts(spark, sf_dir):
    rules = {
        "user_id_in_range": Q.outside_range("user_id", 5, 1000),
        "event_type_known": Q.outside_set("event_type", ["view", "click", "purchase"]),
        "timestamp_in_range": Q.bad_time("timestamp", "2024-01-05 00:00:00", "2024-01-25 12:00:00"),
    }
    return Q.rule_counts(_decoded(spark, sf_dir, "user_id", "event_type", "timestamp"), rules)


@_query
def dq_unknown_products(spark, sf_dir):
    return Q.unknown_products(feeds.click_events(spark, sf_dir), feeds.stocked(spark, sf_dir))


@_query
def dq_duplicate_ids(spark, sf_dir):
    """Over a feed in which purchases were delivered twice and errors three times."""
    events = feeds.click_events(spark, sf_dir).select("event_id", "event_type")
    copies = F.when(F.col("event_type") == "purchase", 2).when(F.col("event_type") == "error", 3).otherwise(1)
    return Q.duplicate_ids(events.select("event_id", F.explode(F.sequence(F.lit(1), copies)).alias("delivery")))


@_query
def dq_category_mismatch(spark, sf_dir):
    seen = _decoded(spark, sf_dir, "product_id", "category")
    return Q.category_mismatches(seen, feeds.catalogue(spark, sf_dir))


@_query
def dq_order_violations(spark, sf_dir):
    """Over a feed in which purchases arrive some fifty events late."""
    return Q.order_violations(feeds.numbered_arrivals(spark, sf_dir), "arrival", chunk=50_000)
