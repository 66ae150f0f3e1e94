"""Report text, one row per line: ``(report_date, line_no, line)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clicklake import schema as S
from clicklake.functions.text import conversion_line, product_line, segment_line
from clicklake.operators.products import ranked_within


def segment_summary_lines(distribution: DataFrame) -> DataFrame:
    """``<segment>: <users>`` from a distribution, other columns kept."""
    return distribution.withColumn("line", segment_line()).drop("segment", "users")


def _numbered(line_no: Column, line: Column) -> Column:
    return F.struct(line_no.alias("line_no"), line.alias("line"))


def _with_heading(ranked: DataFrame, day: str, title: str, line: Column) -> DataFrame:
    """Lines of a ranked table; the day's first row also yields the title and the rule above it."""
    body = _numbered(F.col("rank") + 2, line)
    first = F.array(_numbered(F.lit(1), F.lit(title)), _numbered(F.lit(2), F.lit(S.RULE_LINE)), body)
    lines = F.when(F.col("rank") == 1, first).otherwise(F.array(body))
    return ranked.select(F.col(day).alias("report_date"), F.inline(lines)).where(F.col("line").isNotNull())


def top_products_lines(product_counts: DataFrame, k: int = S.TOP_K, day: str = "event_date") -> DataFrame:
    """Title, rule and the k most viewed products of each day, from ``(day, product_id, views)``.

    Products without a view must be part of the input only so that a day with events but no views keeps its heading.
    """
    ranked = ranked_within(product_counts, day, order=[F.desc("views"), F.asc("product_id")]).where(F.col("rank") <= k)
    viewed = F.when(F.col("views") > 0, product_line())
    return _with_heading(ranked.withColumn("view_count", F.col("views")), day, S.TOP_PRODUCTS_TITLE.format(k=k), viewed)


def conversion_lines(conversion: DataFrame, day: str = "event_date") -> DataFrame:
    """Title, rule and every category of each day, best rate first."""
    ranked = ranked_within(conversion, day, order=[F.desc("conversion_rate"), F.asc("category")])
    return _with_heading(ranked, day, S.CONVERSION_TITLE, conversion_line())


def _joined(lines: DataFrame, name: str) -> DataFrame:
    ordered = F.sort_array(F.collect_list(F.struct("line_no", "line")))
    return lines.groupBy("report_date").agg(F.array_join(F.transform(ordered, lambda e: e["line"]), "\n").alias(name))


def daily_report_body(top_lines: DataFrame, rate_lines: DataFrame, report_root: str, k: int = S.TOP_K) -> DataFrame:
    """One message body per day from the two line reports.

    Only lines are collected: k + 2 products and the categories + 2 of one day. The line reports themselves stay the form
    for catalogues too large to be read in a message.
    """
    return (
        _joined(top_lines, "top")
        .join(_joined(rate_lines, "rates"), "report_date")
        .select(
            "report_date",
            F.format_string(
                S.REPORT_BODY,
                F.col("report_date").cast("string"),
                F.lit(k),
                "top",
                "rates",
                F.concat(F.lit(f"{report_root.rstrip('/')}/*/report_date="), F.col("report_date").cast("string")),
            ).alias("body"),
        )
    )
