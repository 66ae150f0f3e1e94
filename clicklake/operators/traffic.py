"""The mix of event types over time, peak bands, and merged feeds."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from clicklake import schema as S
from clicklake.functions.time import micros


def _counts_per_type(events: DataFrame, bucket: Column) -> DataFrame:
    return events.groupBy(bucket.alias("bucket"), "event_type").agg(F.count("*").alias("events"))


def _share(counts: DataFrame) -> DataFrame:
    """Each type's share of its bucket; the window sees one row per type and bucket."""
    total = F.sum("events").over(Window.partitionBy("bucket"))
    return counts.withColumn("share", F.col("events") / total)


def event_mix(events: DataFrame, bucket: Column) -> DataFrame:
    return _share(_counts_per_type(events, bucket))


def event_mix_drift(events: DataFrame, bucket: Column, expected: dict[str, float]) -> DataFrame:
    """Observed minus expected share, per bucket and type; a type missing on either side counts as zero there.

    The expected types join in as extra rows of each bucket's first type, so the events are read and counted once.
    """
    scale = sum(expected.values())

    def row(event_type: Column, events: Column, share: Column) -> Column:
        return F.struct(event_type.alias("event_type"), events.alias("events"), share.alias("expected_share"))

    observed = row(F.col("event_type"), F.col("events"), F.lit(0.0))
    wanted = [row(F.lit(t), F.lit(0).cast("bigint"), F.lit(w / scale)) for t, w in expected.items()]
    first_type = F.row_number().over(Window.partitionBy("bucket").orderBy("event_type")) == 1
    both = (
        _counts_per_type(events, bucket)
        .withColumn("first_type", first_type)
        .select("bucket", F.inline(F.when(F.col("first_type"), F.array(observed, *wanted)).otherwise(F.array(observed))))
    )
    merged = both.groupBy("bucket", "event_type").agg(
        F.sum("events").alias("events"), F.max("expected_share").alias("expected_share")
    )
    return _share(merged).withColumn("drift", F.col("share") - F.col("expected_share"))


def band_activity(
    events: DataFrame,
    time: str = "event_time",
    band: tuple[float, float] = S.PEAK_BAND,
    time_range: tuple[datetime | str, datetime | str] | None = None,
) -> DataFrame:
    """Events per type inside and outside the peak band, the middle of a time range (both edges included); events without a time are in neither.

    Without a given range it is the table's own: a scalar subquery of one row, so that events are compared with two constants
    and never joined.
    """
    if time_range is None:
        first, last = F.min(micros(time)), F.max(micros(time))
    else:
        first, last = (micros(F.lit(edge).cast("timestamp")) for edge in time_range)
    low, high = (first + F.bround((last - first) * F.lit(part)).cast("bigint") for part in band)
    edges = F.struct(low.alias("start"), high.alias("end"))
    if time_range is None:
        edges = events.agg(edges.alias("edges")).scalar()
    labelled = events.where(F.col(time).isNotNull()).select("event_type", micros(time).alias("at"), edges.alias("edges"))
    peak = F.col("at").between(F.col("edges.start"), F.col("edges.end"))
    return labelled.groupBy(F.when(peak, "peak").otherwise("off_peak").alias("band"), "event_type").agg(
        F.count("*").alias("events")
    )


def merge_feeds(feeds: dict[str, DataFrame]) -> DataFrame:
    """All events of several feeds with the name of their feed; columns a feed lacks are NULL.

    Order by time belongs to the sink (``sinks.write_time_ordered``).
    """
    named = [feed.withColumn("feed", F.lit(name)) for name, feed in feeds.items()]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), named)
