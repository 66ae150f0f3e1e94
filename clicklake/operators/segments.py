"""User segments from activity counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clicklake import schema as S
from clicklake.functions.metrics import three_way_segment, two_way_segment


def segments_three_way(user_counts: DataFrame, min_views: int = S.WINDOW_SHOPPER_MIN_VIEWS) -> DataFrame:
    """Buyer / Window Shopper / Casual Visitor; the default rule."""
    return user_counts.withColumn("segment", three_way_segment(min_views))


def segments_two_way(user_counts: DataFrame) -> DataFrame:
    """Buyer / Window Shopper: whoever bought nothing, even without a view, is a window shopper."""
    return user_counts.withColumn("segment", two_way_segment())


def segment_distribution(segments: DataFrame, *keys: str) -> DataFrame:
    return segments.groupBy(*keys, "segment").agg(F.count("*").alias("users"))
