"""From message bytes to typed events, and the two validity rules."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from clicklake import schema as S
from clicklake.functions.time import parsed_time


def decode_events(messages: DataFrame, *fields: str, schema: StructType = S.EVENT_SCHEMA, value: str = "value") -> DataFrame:
    """JSON in ``value`` (bytes or text) to event columns plus, with the timestamp, ``event_time``.

    Unreadable documents become rows of NULLs and unreadable times become NULL; nothing is dropped here. Naming ``fields``
    builds only those, which a query over few fields of many messages should do.

    The parsed document is unpacked by a generator, not a projection: Catalyst copies projected expressions into every
    filter above them, and each copy would parse the JSON again.
    """
    wanted = StructType([schema[name] for name in fields]) if fields else schema
    events = messages.select(F.inline(F.array(F.from_json(F.col(value).cast("string"), wanted))))
    return events.withColumn("event_time", parsed_time("timestamp")) if "timestamp" in wanted.names else events


def with_event_date(events: DataFrame, time: str = "event_time") -> DataFrame:
    return events.withColumn("event_date", F.to_date(time))


def _known(*columns: str) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def alertable(events: DataFrame) -> DataFrame:
    """Events an alert can count: product, time and type are known."""
    return events.where(_known("product_id", "event_time", "event_type"))


def archivable(events: DataFrame) -> DataFrame:
    """Events the lake can place: the time is known."""
    return events.where(_known("event_time"))
