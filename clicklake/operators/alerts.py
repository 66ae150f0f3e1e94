"""Flash-sale alerts: products much viewed and little bought within a sliding window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clicklake import schema as S
from clicklake.functions.metrics import summed_views_and_purchases, views_and_purchases


def _alerts(window_counts: DataFrame, rule: S.AlertRule) -> DataFrame:
    fires = (F.col("views") >= rule.min_views) & (F.col("purchases") < rule.purchases_below)
    return window_counts.where(fires).select(
        F.col("span.start").alias("start"),
        F.col("span.end").alias("end"),
        "product_id",
        F.col("views").alias("view_count"),
        F.col("purchases").alias("purchase_count"),
        F.lit(rule.action).alias("action"),
    )


def _window_counts(rows: DataFrame, time: str, rule: S.AlertRule, counts: list[Column]) -> DataFrame:
    return rows.groupBy(F.window(time, rule.window, rule.slide).alias("span"), "product_id").agg(*counts)


def flash_sale_alerts(events: DataFrame, rule: S.AlertRule = S.AlertRule(), time: str = "event_time") -> DataFrame:
    """Alert rows for a table or a stream.

    A table whose windows are whole slides is first counted per (product, slide): every event is touched once and the
    window/slide-fold copies are made of the counts. A stream keeps one stateful count, and keeps events of other types,
    because they too advance the watermark.
    """
    if events.isStreaming:
        return _alerts(_window_counts(events, time, rule, views_and_purchases()), rule)
    if rule.min_views >= 1:
        # A window without a view cannot fire, and other types change neither count.
        events = events.where(F.col("event_type").isin(S.VIEW, S.PURCHASE))
    if not rule.windows_are_whole_slides:
        return _alerts(_window_counts(events, time, rule, views_and_purchases()), rule)
    per_slide = (
        events.groupBy(F.window(time, rule.slide).alias("slide"), "product_id")
        .agg(*views_and_purchases())
        .select(F.col("slide.start").alias("slide_start"), "product_id", "views", "purchases")
    )
    return _alerts(_window_counts(per_slide, "slide_start", rule, summed_views_and_purchases()), rule)
