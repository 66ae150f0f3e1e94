"""Column expressions shared by the aggregating operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from clicklake import schema as S


def occurrences(event_type: str, name: str) -> Column:
    """How many rows of the group are of this type; rows without a type count for none."""
    return F.count_if(F.col("event_type") == event_type).alias(name)


def views_and_purchases() -> list[Column]:
    return [occurrences(S.VIEW, "views"), occurrences(S.PURCHASE, "purchases")]


def summed_views_and_purchases() -> list[Column]:
    """The same two counts, when the input already holds partial counts."""
    return [F.sum(name).alias(name) for name in ("views", "purchases")]


def conversion_rate() -> Column:
    """Purchases per view in single precision, widened; 0.0 where nothing was viewed."""
    rate = F.try_divide(F.col("purchases"), F.col("views")).cast("float").cast("double")
    return F.coalesce(rate, F.lit(0.0))


def three_way_segment(min_views: int = S.WINDOW_SHOPPER_MIN_VIEWS) -> Column:
    return (
        F.when(F.col("purchases") > 0, S.BUYER)
        .when(F.col("views") >= min_views, S.WINDOW_SHOPPER)
        .otherwise(S.CASUAL)
    )


def two_way_segment() -> Column:
    return F.when(F.col("purchases") > 0, S.BUYER).otherwise(S.WINDOW_SHOPPER)
