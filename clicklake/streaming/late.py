"""Events behind the watermark, kept instead of silently dropped.

A windowed stream drops what comes too late for its windows. This job runs beside it on the same messages and writes each late event once,
with how far behind it was and how many of the alert windows it had missed. The watermark of a batch is the latest event time of
the batches before it less the delay, as the alert stream has it; one row per batch holds it, beside the events.

Every batch writes folders of its own number and reads the mark of the batch before, so a batch that is run again after a failure replaces
what it wrote and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clicklake import schema as S
from clicklake.functions.time import MICROS, micros
from clicklake.operators.decode import decode_events
from clicklake.sources.files import file_system
from clicklake.streaming.run import triggered

_MARK = "mark timestamp"


def missed_windows(time: str | Column, mark: Column, rule: S.AlertRule) -> Column:
    """How many of the sliding windows that the time falls in had ended by the mark."""
    window, slide = rule.window_seconds * MICROS, rule.slide_seconds * MICROS
    at, last = micros(time), F.least(micros(mark), micros(time) + window)  # their ends lie after the time, and at the mark or before it
    ends = lambda until: F.floor((until - window % slide) / F.lit(slide))
    return F.greatest(F.lit(0), ends(last) - ends(at)).cast("bigint")


def late_rows(events: DataFrame, mark: Column, rule: S.AlertRule = S.AlertRule(), time: str = "event_time") -> DataFrame:
    """The events before the mark, with ``behind_seconds`` and ``missed_windows``."""
    behind = (micros(mark) - micros(time)) / F.lit(MICROS)
    late = events.where(F.col(time) < mark)
    return late.withColumn("behind_seconds", behind).withColumn("missed_windows", missed_windows(time, mark, rule))


def _mark_before(spark: SparkSession, root: str, batch: int) -> Column:
    if batch:
        path = f"{root}/marks/batch={batch - 1}"
        system, at = file_system(spark, path)
        if system.exists(at):
            found = spark.read.schema(_MARK).parquet(path).first()
            return F.lit(found["mark"]) if found else F.lit(None).cast("timestamp")
    return F.lit(None).cast("timestamp")


def _keep_late(events: DataFrame, batch: int, root: str, rule: S.AlertRule, delay: str) -> None:
    spark = events.sparkSession
    mark = _mark_before(spark, root, batch)
    late_rows(events, mark, rule).write.mode("overwrite").parquet(f"{root}/late/batch={batch}")
    latest = F.max("event_time") - F.expr(f"interval {delay}")
    events.agg(F.greatest(latest, mark).alias("mark")).write.mode("overwrite").parquet(f"{root}/marks/batch={batch}")


def start_late_events(
    messages: DataFrame,
    root: str,
    every: str | None = S.ALERT_TRIGGER,
    rule: S.AlertRule = S.AlertRule(),
    delay: str = S.WATERMARK_DELAY,
    name: str = "late-events",
) -> StreamingQuery:
    """Write the late events of a stream of messages under ``root``, one folder per batch; the checkpoint lies beside them."""
    events = decode_events(messages).where(F.col("event_time").isNotNull())
    writer = events.writeStream.queryName(name).option("checkpointLocation", f"{root}/{S.CHECKPOINTS}/{name}")
    return triggered(writer.foreachBatch(lambda batch, number: _keep_late(batch, number, root, rule, delay)), every).start()


def read_late_events(spark: SparkSession, root: str) -> DataFrame:
    """All late events so far, with the batch that brought them."""
    fields = ", ".join(f"`{f.name}` string" for f in S.EVENT_SCHEMA.fields)
    schema = f"{fields}, event_time timestamp, behind_seconds double, missed_windows bigint, batch int"
    return spark.read.schema(schema).option("basePath", f"{root}/late").parquet(f"{root}/late")
