"""User sessions: runs of events with no pause longer than the gap.

Two events in one gap-wide time cell always share a session. So events are first counted per (user, cell), combined
map-side, and only the cells are put in order per user: at most time range / gap of them, however many events a user has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clicklake import schema as S
from clicklake.functions.time import MICROS, micros, time_cell


def _session_cells(events: DataFrame, gap_seconds: int, time: str, *more: Column) -> DataFrame:
    """Per (user, cell): first and last time, events, more aggregates, and the number of the user's session."""
    cells = (
        events.where(F.col(time).isNotNull())
        .groupBy("user_id", time_cell(time, gap_seconds).alias("cell"))
        .agg(F.min(time).alias("first"), F.max(time).alias("last"), F.count("*").alias("n"), *more)
    )
    by_time = Window.partitionBy("user_id").orderBy("first")
    earlier = by_time.rowsBetween(Window.unboundedPreceding, -1)
    up_to_here = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pause = micros("first") - micros(F.max("last").over(earlier))
    return cells.withColumn("pause", pause).withColumn(
        "session_no", F.count_if(F.col("pause") > gap_seconds * MICROS).over(up_to_here)
    )


def user_sessions(events: DataFrame, gap_seconds: int = S.SESSION_GAP_SECONDS, time: str = "event_time") -> DataFrame:
    """Start, last event, number of events and duration of every session; a pause of exactly the gap does not split."""
    cells = _session_cells(events, gap_seconds, time)
    return (
        cells.groupBy("user_id", "session_no")
        .agg(F.min("first").alias("session_start"), F.max("last").alias("last_event"), F.sum("n").alias("events"))
        .withColumn("duration_seconds", (micros("last_event") - micros("session_start")) / F.lit(MICROS))
        .drop("session_no")
    )


def session_outcomes(
    events: DataFrame,
    gap_seconds: int = S.SESSION_GAP_SECONDS,
    time: str = "event_time",
    cart_type: str = S.CART,
    purchase_type: str = S.PURCHASE,
    order: str = "event_id",
) -> DataFrame:
    """How each session ended: last event type, was anything put in the cart, was the last event a purchase.

    Of events at the very same instant the one with the largest ``order`` is the last.
    """
    latest = F.struct(F.col(time).alias("time"), F.col(order).alias("order"), F.col("event_type").alias("event_type"))
    cart = F.coalesce(F.bool_or(F.col("event_type") == cart_type), F.lit(False))
    cells = _session_cells(events, gap_seconds, time, F.max(latest).alias("latest"), cart.alias("cart"))
    return (
        cells.groupBy("user_id", "session_no")
        .agg(
            F.min("first").alias("session_start"),
            F.sum("n").alias("events"),
            F.max("latest").getField("event_type").alias("last_event_type"),
            F.bool_or("cart").alias("has_cart"),
        )
        .withColumn("ends_in_purchase", F.col("last_event_type").eqNullSafe(purchase_type))
        .drop("session_no")
    )
