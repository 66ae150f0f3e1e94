"""User sessions from a stream: sessions grow and merge in the state, and leave it, once, when the watermark has passed their gap."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from clicklake import schema as S
from clicklake.functions.time import MICROS, micros
from clicklake.operators.decode import decode_events
from clicklake.streaming.run import triggered


def closed_sessions(
    messages: DataFrame, gap_seconds: int = S.SESSION_GAP_SECONDS, delay: str = S.WATERMARK_DELAY, user_type: str = "string"
) -> DataFrame:
    """``operators.sessions.user_sessions`` for a stream, in append mode: the same columns, a row when the session can no longer grow.

    A pause of exactly the gap does not split: windows that touch are merged. Late events that a session would have had are dropped;
    ``streaming.late`` keeps them. Events without a user are the user NULL, which the state could not hold as a key: a flag stands for it.
    """
    events = decode_events(messages, "user_id", "timestamp").where(F.col("event_time").isNotNull()).withWatermark("event_time", delay)
    span = F.session_window("event_time", f"{gap_seconds} seconds").alias("span")
    sessions = events.groupBy(F.isnull("user_id").alias("unnamed"), F.coalesce("user_id", F.lit("")).alias("user"), span).agg(
        F.min("event_time").alias("session_start"), F.max("event_time").alias("last_event"), F.count("*").alias("events")
    )
    duration = (micros("last_event") - micros("session_start")) / F.lit(MICROS)
    user = F.when(~F.col("unnamed"), F.col("user")).cast(user_type).alias("user_id")
    return sessions.select(user, "session_start", "last_event", "events", duration.alias("duration_seconds"))


def start_sessions(sessions: DataFrame, path: str, checkpoint: str, every: str | None = S.ARCHIVE_TRIGGER, name: str = "sessions") -> StreamingQuery:
    writer = sessions.writeStream.format("parquet").queryName(name).outputMode("append")
    return triggered(writer.option("path", path).option("checkpointLocation", checkpoint), every).start()
