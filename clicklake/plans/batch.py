"""The plain batch run: a directory of JSON events to top products, user segments and run statistics."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from clicklake import schema as S
from clicklake.functions.time import as_day
from clicklake.operators.activity import run_statistics, user_activity
from clicklake.operators.products import top_products
from clicklake.operators.segments import segments_three_way
from clicklake.plans.daily import ReportPaths, at_once, staged
from clicklake.session import scratch_dir, sized_shuffles
from clicklake.sources import sinks
from clicklake.sources.files import read_json_events
from clicklake.sources.inventory import input_bytes


def _dated(rows: DataFrame, day: date | str) -> DataFrame:
    return rows.withColumn(sinks.DAY, F.lit(as_day(day)))


def write_batch_reports(
    spark: SparkSession,
    json_path: str,
    report_root: str,
    report_date: date | str,
    k: int = S.TOP_K,
    min_views: int = S.WINDOW_SHOPPER_MIN_VIEWS,
    schema: StructType | str = S.EVENT_SCHEMA,
) -> ReportPaths:
    """Reports over everything in the directory, stamped with ``report_date``; a rerun for the date replaces them, also by nothing.

    ``schema`` gives the events' types: with ``user_id bigint`` the users of the reports are numbers. The JSON is parsed once, to a
    table of the three columns that the reports need; each report is computed once, before it is written.
    """
    paths, day = ReportPaths(report_root), (report_date, report_date)
    run = scratch_dir(spark, "batch-run")
    with sized_shuffles(spark, input_bytes(spark, json_path)):
        parsed = read_json_events(spark, json_path, schema).select("user_id", "product_id", "event_type")
        parsed.write.parquet(f"{run}/events")
        events = spark.read.schema(parsed.schema).parquet(f"{run}/events")
        top, segments, statistics = at_once(
            lambda: staged(_dated(top_products(events, k), report_date), f"{run}/top"),
            lambda: staged(_dated(segments_three_way(user_activity(events), min_views), report_date), f"{run}/segments"),
            lambda: staged(_dated(run_statistics(events), report_date), f"{run}/statistics"),
        )
        at_once(
            lambda: sinks.write_json_report(top, paths.of("batch_top_products"), F.desc("view_count"), "product_id", days=day),
            lambda: sinks.write_table(segments, paths.of("batch_user_segments"), "json", days=day),
            lambda: sinks.write_json_report(statistics, paths.of("batch_statistics"), days=day),
        )
    return paths
