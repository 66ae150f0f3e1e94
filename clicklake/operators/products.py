"""Most viewed products."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from clicklake import schema as S
from clicklake.operators.activity import product_view_counts


def top_products(events: DataFrame, k: int = S.TOP_K) -> DataFrame:
    """The k most viewed products, ties by product id; each task keeps only its own k."""
    return product_view_counts(events).orderBy(F.desc("view_count"), F.asc("product_id")).limit(k)


def ranked_within(rows: DataFrame, *keys: str, order: list, name: str = "rank") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def daily_top_products(events: DataFrame, k: int = S.TOP_K, day: str = "event_date") -> DataFrame:
    """The k most viewed products of every day at once; the rank filter limits each task before the shuffle by day."""
    counts = product_view_counts(events, day)
    ranked = ranked_within(counts, day, order=[F.desc("view_count"), F.asc("product_id")])
    return ranked.where(F.col("rank") <= k)
