"""The daily reports: all days of a range in one run, reports derived from results written for the run."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from clicklake import schema as S
from clicklake.functions.metrics import two_way_segment, views_and_purchases
from clicklake.operators.activity import daily_user_activity, rolled_up
from clicklake.operators.conversion import with_conversion_rate
from clicklake.operators.products import ranked_within
from clicklake.operators.reports import conversion_lines, daily_report_body, segment_summary_lines, top_products_lines
from clicklake.operators.segments import segment_distribution, segments_three_way
from clicklake.plans.distinct import daily_sketches
from clicklake.session import scratch_dir, sized_shuffles
from clicklake.sources import sinks
from clicklake.sources.files import read_lake
from clicklake.sources.inventory import lake_bytes

T = TypeVar("T")


@dataclass(frozen=True)
class ReportPaths:
    """Where each report lies under the root; every directory is partitioned by ``report_date``."""

    root: str

    def of(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{S.REPORTS}/{name}"

    def read(self, spark: SparkSession, name: str, fmt: str = "parquet", schema: StructType | str | None = None, **options: str) -> DataFrame:
        """A report; with its schema given, one without any day is just empty."""
        reader = spark.read.format(fmt).options(**options)
        return (reader if schema is None else reader.schema(schema)).load(self.of(name))


def at_once(*jobs: Callable[[], T]) -> list[T]:
    """Run independent Spark jobs side by side, so that small ones fill the gaps of large ones; the first failure is raised."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [done.result() for done in [pool.submit(job) for job in jobs]]


def daily_segments(events: DataFrame, min_views: int = S.WINDOW_SHOPPER_MIN_VIEWS) -> DataFrame:
    """Segments of every user and day, under both rules."""
    users = segments_three_way(daily_user_activity(events), min_views).withColumn("segment_two_way", two_way_segment())
    return users.withColumnRenamed("event_date", sinks.DAY)


def daily_product_counts(events: DataFrame) -> DataFrame:
    """Events, views and purchases per day, product and category: all that the product and category reports and the statistics need."""
    counts = events.groupBy("event_date", "product_id", "category").agg(F.count("*").alias("events"), *views_and_purchases())
    return counts.withColumnRenamed("event_date", sinks.DAY)


def statistics_of(counts: DataFrame, segments: DataFrame) -> DataFrame:
    """``run_statistics`` of each day from its counts per product and its users' segments, without another look at the events."""
    products = counts.groupBy(sinks.DAY).agg(
        F.sum("events").alias("records_processed"), F.count_distinct("product_id").alias("unique_products")
    )
    users = segments.groupBy(sinks.DAY).agg(F.count("user_id").alias("unique_users"))
    return products.join(users, sinks.DAY)


def staged(rows: DataFrame, path: str) -> DataFrame:
    """The rows written to a folder of this run and read back with their schema."""
    rows.hint("rebalance").write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def segment_summary(segments: DataFrame) -> DataFrame:
    """The distribution as numbered lines per day."""
    lines = segment_summary_lines(segment_distribution(segments, sinks.DAY))
    return ranked_within(lines, sinks.DAY, order=[F.asc("line")], name="line_no")


def top_of_counts(per_product: DataFrame, k: int = S.TOP_K) -> DataFrame:
    """The k most viewed products of each day from counts per day and product."""
    viewed = per_product.where(F.col("views") > 0).select(sinks.DAY, "product_id", F.col("views").alias("view_count"))
    ranked = ranked_within(viewed, sinks.DAY, order=[F.desc("view_count"), F.asc("product_id")])
    return ranked.where(F.col("rank") <= k)


def write_daily_reports(
    spark: SparkSession,
    lake_root: str,
    first: date | str,
    last: date | str,
    report_root: str | None = None,
    k: int = S.TOP_K,
    min_views: int = S.WINDOW_SHOPPER_MIN_VIEWS,
) -> ReportPaths:
    """All reports for the days ``first`` to ``last``. A rerun replaces all of them: a day, or a report of it, that has
    become empty is removed; a range without events yields empty reports.

    The lake is read twice, two columns per user and three per product. Segments, counts and the two ranked tables are written to a folder
    of this run, and all reports come from those.
    """
    paths, days = ReportPaths(report_root or lake_root), (first, last)
    run = scratch_dir(spark, "daily-run")
    events = read_lake(spark, lake_root, first, last)
    with sized_shuffles(spark, lake_bytes(spark, lake_root, first, last)):
        segments, counts = at_once(
            lambda: staged(daily_segments(events, min_views), f"{run}/segments"),
            lambda: staged(daily_product_counts(events), f"{run}/counts"),
        )
    per_product, top, conversion, summary, two_way, statistics, sketches = at_once(
        lambda: staged(rolled_up(counts, sinks.DAY, "product_id"), f"{run}/products"),
        lambda: staged(top_of_counts(rolled_up(counts, sinks.DAY, "product_id"), k), f"{run}/top"),
        lambda: staged(with_conversion_rate(rolled_up(counts, sinks.DAY, "category")), f"{run}/conversion"),
        lambda: staged(segment_summary(segments), f"{run}/summary"),
        lambda: staged(segment_summary(segments.withColumn("segment", F.col("segment_two_way"))), f"{run}/two_way"),
        lambda: staged(statistics_of(counts, segments), f"{run}/statistics"),
        lambda: staged(daily_sketches(counts, segments), f"{run}/sketches"),
    )
    best_first = (F.desc("conversion_rate"), F.asc("category"))
    top_lines = top_products_lines(per_product, k, sinks.DAY)
    rate_lines = conversion_lines(conversion, sinks.DAY)
    body = daily_report_body(top_lines, rate_lines, paths.of(""), k)
    at_once(
        lambda: sinks.write_table(segments, paths.of("user_segments"), days=days),
        lambda: sinks.write_table(segments, paths.of("user_segments_json"), "json", days=days),
        lambda: sinks.write_table(counts.drop("events"), paths.of("product_counts"), days=days),
        lambda: sinks.write_table(sketches, paths.of("daily_sketches"), days=days),
        lambda: sinks.write_json_report(statistics, paths.of("run_statistics"), days=days),
        lambda: sinks.write_text_report(summary, paths.of("segment_summary"), days=days),
        lambda: sinks.write_text_report(two_way, paths.of("segment_summary_two_way"), days=days),
        lambda: sinks.write_json_report(top, paths.of("top_products_json"), "rank", days=days),
        lambda: sinks.write_csv_report(top, paths.of("top_products_csv"), "rank", days=days),
        lambda: sinks.write_json_report(conversion, paths.of("category_conversion_json"), *best_first, days=days),
        lambda: sinks.write_csv_report(conversion, paths.of("category_conversion_csv"), *best_first, days=days),
        lambda: sinks.write_text_report(top_lines, paths.of("top_products_text"), days=days),
        lambda: sinks.write_text_report(rate_lines, paths.of("category_conversion_text"), days=days),
        lambda: sinks.write_json_report(body, paths.of("body"), days=days),
    )
    return paths
