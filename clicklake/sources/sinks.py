"""Batch sinks. A rerun replaces the days it has rows for (dynamic partition overwrite), and, given a range, all days of the range."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from clicklake.functions.time import as_day
from clicklake.sources.files import days_below, file_system, is_stream_written

DAY = "report_date"
Range = tuple[date | str, date | str]


def _remove_empty_days(rows: DataFrame, path: str, day: str, days: Range) -> None:
    """Remove the days of the range that a former run wrote and this one has no rows for; a value per day comes to the driver."""
    spark, (first, last) = rows.sparkSession, (as_day(d) for d in days)
    old = {d: at for d, at in days_below(spark, path, day).items() if first <= d <= last}
    if old:
        held = {r[0] for r in rows.select(F.col(day).cast("date")).distinct().collect()}
        for at in (at for d, at in old.items() if d not in held):
            system, where = file_system(spark, at)
            system.delete(where, True)


def _replace_days(written: DataFrame, rows: DataFrame, path: str, fmt: str, day: str, days: Range | None, **options: str) -> None:
    if is_stream_written(rows.sparkSession, path):
        raise ValueError(f"{path} is written by a stream: rows added by a batch would not be read; write them to a root of their own")
    (
        written.write.mode("overwrite")
        .format(fmt)
        .options(partitionOverwriteMode="dynamic", **options)
        .partitionBy(day)
        .save(path)
    )
    if days is not None:
        _remove_empty_days(rows, path, day, days)


def by_day(rows: DataFrame, day: str, finish: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows gathered by day for a write. With ``finish`` they are also sorted here, as a write by day needs them, so that what it makes
    of them, such as long lines, is neither shuffled nor sorted; it must keep the day and the order of the rows."""
    gathered = rows.hint("rebalance", day)
    return gathered if finish is None else finish(gathered.sortWithinPartitions(day))


def write_table(
    rows: DataFrame,
    path: str,
    fmt: str = "parquet",
    day: str = DAY,
    days: Range | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    **options: str,
) -> None:
    """A result of any size, one directory per day; ``days`` is the range that the run stands for.

    The rebalance hint gathers a day's rows into few files and, at run time, splits a day that is too large for one task. ``finish``
    makes the rows as they are written from narrower ones, after they are gathered; a day is split by the size of the narrow ones.
    """
    _replace_days(by_day(rows, day, finish), rows, path, fmt, day, days, **options)


def write_report(
    rows: DataFrame, path: str, fmt: str, *order: str | Column, day: str = DAY, days: Range | None = None, keep_order: bool = True, **options: str
) -> None:
    """A report with few rows per day (k products, the categories, the segments): one ordered file per day.

    One task writes a day, so it is for bounded reports only; ``write_table`` takes results of any size.

    Columns named in ``order`` sort the file; with ``keep_order=False`` they are dropped after sorting.
    """
    placed = rows.repartition(F.col(day)).sortWithinPartitions(day, *order)
    if not keep_order:
        placed = placed.drop(*order)
    _replace_days(placed, rows, path, fmt, day, days, **options)


def write_json_report(rows: DataFrame, path: str, *order: str | Column, day: str = DAY, days: Range | None = None) -> None:
    write_report(rows, path, "json", *order, day=day, days=days)


def write_csv_report(rows: DataFrame, path: str, *order: str | Column, day: str = DAY, days: Range | None = None) -> None:
    write_report(rows, path, "csv", *order, day=day, days=days, header="true")


def write_text_report(lines: DataFrame, path: str, day: str = DAY, days: Range | None = None) -> None:
    """Lines ``(day, line_no, line)`` to one text file per day, a line per row."""
    write_report(lines.select(day, "line_no", "line"), path, "text", "line_no", day=day, days=days, keep_order=False)


def write_time_ordered(
    events: DataFrame, path: str, time: str = "event_time", tie_break: str = "event_id", fmt: str = "parquet"
) -> None:
    """Events in global time order over the files: range partitions, each sorted.

    The tie-break and the number of the input partition belong to the range key, so neither one instant with very many events
    nor very many copies of one event meet in one task.
    """
    placed = events.withColumn("_input", F.spark_partition_id()).repartitionByRange(time, tie_break, "_input")
    placed.sortWithinPartitions(time, tie_break).drop("_input").write.mode("overwrite").format(fmt).save(path)
