"""Jobs for spark-submit: ``archive``, ``totals`` and ``alerts`` (streams from a topic), ``daily`` (reports for a range of days),
``batch`` (reports over a directory of JSON events) and ``inventory`` (what the lake holds).

Storage credentials, cores and memory come from the submit-time configuration.
"""

from __future__ import annotations

import argparse
from datetime import date

from clicklake import schema as S
from clicklake.plans.batch import write_batch_reports
from clicklake.plans.daily import write_daily_reports
from clicklake.session import build_session, stream_session
from clicklake.sources import inventory, kafka
from clicklake.streaming.alerts import alert_rows, alert_writer, start_alerts
from clicklake.streaming.archive import start_archive
from clicklake.streaming.run import wait
from clicklake.streaming.totals import start_daily_totals


BACKFILL_OFFSETS = 20_000_000


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="clicklake")
    jobs = parser.add_subparsers(dest="job", required=True)

    topic = argparse.ArgumentParser(add_help=False)
    topic.add_argument("--servers", required=True, help="Kafka bootstrap servers")
    topic.add_argument("--topic", default="clickstream-events")
    topic.add_argument("--starting-offsets", help="default: latest, or earliest with --backfill")
    topic.add_argument("--allow-data-loss", action="store_true", help="go on when offsets have aged out of the topic")
    topic.add_argument("--max-offsets-per-trigger", type=int)
    topic.add_argument("--min-partitions", type=int)
    topic.add_argument("--backfill", action="store_true", help="process what is available, then end")

    archive = jobs.add_parser("archive", parents=[topic])
    archive.add_argument("--lake", required=True)
    archive.add_argument("--every", default=S.ARCHIVE_TRIGGER)

    totals = jobs.add_parser("totals", parents=[topic])
    totals.add_argument("--root", required=True, help="folder of the daily totals and of the checkpoint")
    totals.add_argument("--every", default=S.ALERT_TRIGGER)

    alerts = jobs.add_parser("alerts", parents=[topic])
    alerts.add_argument("--alerts-topic", default="alerts-notifications")
    alerts.add_argument("--checkpoint", required=True)
    alerts.add_argument("--every", default=S.ALERT_TRIGGER)
    alerts.add_argument("--state-partitions", type=int, help="fixed for the life of the checkpoint")
    alerts.add_argument("--window-seconds", type=int, default=S.ALERT_WINDOW_SECONDS)
    alerts.add_argument("--slide-seconds", type=int, default=S.ALERT_SLIDE_SECONDS)
    alerts.add_argument("--min-views", type=int, default=S.ALERT_MIN_VIEWS)
    alerts.add_argument("--purchases-below", type=int, default=S.ALERT_PURCHASES_BELOW)

    days = argparse.ArgumentParser(add_help=False)
    days.add_argument("--lake", required=True)
    days.add_argument("--first", required=True)
    days.add_argument("--last", help="default: the first day only")

    rules = argparse.ArgumentParser(add_help=False)
    rules.add_argument("--top", type=int, default=S.TOP_K)
    rules.add_argument("--min-views", type=int, default=S.WINDOW_SHOPPER_MIN_VIEWS)

    daily = jobs.add_parser("daily", parents=[days, rules])
    daily.add_argument("--reports", help="default: beside the lake")

    batch = jobs.add_parser("batch", parents=[rules])
    batch.add_argument("--input", required=True)
    batch.add_argument("--reports", required=True)
    batch.add_argument("--report-date", default=date.today().isoformat())
    batch.add_argument("--schema", default=S.EVENT_SCHEMA, help="types of the events' fields as DDL, for users that are numbers")

    inventory_of = jobs.add_parser("inventory", parents=[days])
    inventory_of.add_argument("--output", required=True, help="folder for one JSON row per day; replaced")
    return parser


def _topic_options(args: argparse.Namespace) -> dict[str, str]:
    """A backfill starts at the beginning unless told otherwise; that of the alerts goes in bounded batches, since the watermark, and
    with it the state, moves on between batches only."""
    bound = BACKFILL_OFFSETS if args.backfill and args.job == "alerts" else None
    return kafka.source_options(
        args.servers,
        args.topic,
        args.starting_offsets or ("earliest" if args.backfill else "latest"),
        fail_on_data_loss=not args.allow_data_loss,
        max_offsets_per_trigger=args.max_offsets_per_trigger or bound,
        min_partitions=args.min_partitions,
    )


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"clicklake-{args.job}")
    every = None if getattr(args, "backfill", False) else getattr(args, "every", None)
    if args.job == "archive":
        wait(start_archive(kafka.read_topic(spark, _topic_options(args)), args.lake, every))
    elif args.job == "totals":
        wait(start_daily_totals(kafka.read_topic(spark, _topic_options(args)), args.root, every))
    elif args.job == "alerts":
        rule = S.AlertRule(args.window_seconds, args.slide_seconds, args.min_views, args.purchases_below)
        messages = kafka.read_topic(stream_session(spark, args.state_partitions), _topic_options(args))
        options = kafka.sink_options(args.servers, args.alerts_topic, args.checkpoint)
        wait(start_alerts(alert_writer(alert_rows(messages, rule), args.checkpoint, "kafka", **options), every))
    elif args.job == "daily":
        write_daily_reports(spark, args.lake, args.first, args.last or args.first, args.reports, args.top, args.min_views)
    elif args.job == "batch":
        write_batch_reports(spark, args.input, args.reports, args.report_date, args.top, args.min_views, args.schema)
    else:
        known = inventory.partition_metadata(spark, args.lake)
        presence = inventory.partition_presence(known, args.first, args.last or args.first)
        presence.orderBy("event_date").write.mode("overwrite").json(args.output)
        print(args.output)


if __name__ == "__main__":
    main()
