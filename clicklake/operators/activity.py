"""Counts per product, user, day or any other key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clicklake import schema as S
from clicklake.functions.metrics import summed_views_and_purchases, views_and_purchases


def activity(events: DataFrame, *keys: str) -> DataFrame:
    """Views and purchases per key; a key with neither still gets its row, NULL is a key like any other.

    Counting is combined map-side, so a key with a third of all rows sends one row per task.
    """
    return events.groupBy(*keys).agg(*views_and_purchases())


def rolled_up(counts: DataFrame, *keys: str) -> DataFrame:
    """The same counts on coarser keys, from counts that are already grouped."""
    return counts.groupBy(*keys).agg(*summed_views_and_purchases())


def user_activity(events: DataFrame) -> DataFrame:
    return activity(events, "user_id")


def daily_user_activity(events: DataFrame) -> DataFrame:
    return activity(events, "event_date", "user_id")


def product_view_counts(events: DataFrame, *keys: str) -> DataFrame:
    """Views per product, optionally within further keys; the type filter reaches the Parquet scan."""
    return events.where(F.col("event_type") == S.VIEW).groupBy(*keys, "product_id").agg(F.count("*").alias("view_count"))


def run_statistics(events: DataFrame, *keys: str, approximate: bool = False) -> DataFrame:
    """Records, distinct products and distinct users of a run, or of each day or other key; NULL is not counted as a product or a user."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return events.groupBy(*keys).agg(
        F.count("*").alias("records_processed"),
        distinct("product_id").alias("unique_products"),
        distinct("user_id").alias("unique_users"),
    )
