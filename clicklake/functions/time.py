"""Event-time expressions, and days as a caller gives them."""

from __future__ import annotations

import re
from datetime import date, datetime, time

from pyspark.sql import Column, functions as F

MICROS = 1_000_000
_DAY = re.compile(r"(\d{4})-(\d{1,2})-(\d{1,2})(?:[T ](.+))?")


def as_day(day: date | str) -> date:
    """The day of a date, a datetime or a text such as 2024-01-05, 2024-1-5 or 2024-01-05T10:00; anything else raises ValueError."""
    if isinstance(day, datetime):
        return day.date()
    if isinstance(day, date):
        return day
    found = _DAY.fullmatch(day.strip()) if isinstance(day, str) else None
    if not found:
        raise ValueError(f"{day!r} is no day")
    if found[4]:
        time.fromisoformat(found[4])  # a time of day must at least be one
    return date(*(int(part) for part in found.groups()[:3]))


def parsed_time(text: str | Column) -> Column:
    """Text to timestamp; NULL, never an error, where the text is no timestamp."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def micros(time: str | Column) -> Column:
    """Microseconds since the epoch, for either timestamp type."""
    column = F.col(time) if isinstance(time, str) else time
    return F.unix_micros(column.cast("timestamp"))


def time_cell(time: str | Column, seconds: int) -> Column:
    """Number of the fixed cell of this width that the time falls in."""
    return F.floor(micros(time) / F.lit(seconds * MICROS)).cast("bigint")


def iso_text(time: str | Column) -> Column:
    """ISO-8601 text with all six fractional digits (``to_json`` alone would keep only three)."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
