"""The archive without repeated deliveries.

Delivery is at least once, so a message may come again. This job keeps the ids of the last events in its state and archives an id once, for as
long as the watermark's delay; a copy that comes later than that lies behind the watermark. What was left out is counted, batch by batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clicklake import schema as S
from clicklake.sources.files import exists
from clicklake.streaming.archive import append_to_lake, archive_rows

ACCOUNT = "batch bigint, delivered bigint, archived bigint, copies bigint, behind bigint"
_STEP = "delivered"


def events_once(messages: DataFrame, delay: str = S.WATERMARK_DELAY) -> DataFrame:
    """The rows of ``archive_rows`` for a stream, each id once within the delay; the first that comes is kept.

    The state drops what is behind the watermark, which it could not tell from a copy; ``streaming.late`` keeps those events. An event
    without an id is a copy of another only if all its fields are the same: the fields are then its key, so that such events are neither
    dropped for one another nor all sent to one task.
    """
    fields = [f.name for f in S.EVENT_SCHEMA.fields]
    rows = archive_rows(messages).observe(_STEP, F.count(F.lit(1)).alias("rows"))
    unnamed = F.when(F.col("event_id").isNull(), F.to_json(F.struct(*fields)))
    keyed = rows.withColumn("_unnamed", F.coalesce(unnamed, F.lit(""))).withColumn("_id", F.coalesce("event_id", F.lit("")))
    return keyed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["_id", "_unnamed"]).drop("_id", "_unnamed")


def start_archive_once(
    messages: DataFrame,
    root: str,
    every: str | None = S.ARCHIVE_TRIGGER,
    delay: str = S.WATERMARK_DELAY,
    name: str = "raw-events-once",
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Append each event with a readable time once to the lake under ``root``. ``messages`` come from a ``stream_session``."""
    return append_to_lake(events_once(messages, delay), root, every, name, checkpoint)


def accounts(query: StreamingQuery) -> list[tuple[int, int, int, int, int]]:
    """(batch, delivered, archived, copies, behind the watermark) of the batches the query still remembers; those without rows are left out.

    The sink does not say how many rows it got, so ``archived`` is what was delivered less what the state says it dropped.
    """
    out = []
    for progress in query.recentProgress:
        seen = progress["observedMetrics"].get(_STEP)
        delivered = seen["rows"] if seen else 0
        if delivered:
            states = progress["stateOperators"]
            copies = sum(s["customMetrics"].get("numDroppedDuplicateRows", 0) for s in states)
            behind = sum(s["numRowsDroppedByWatermark"] for s in states)
            out.append((progress["batchId"], delivered, delivered - copies - behind, copies, behind))
    return out


def wait_and_account(spark: SparkSession, query: StreamingQuery, path: str, every_seconds: float = 60) -> None:
    """Wait for the query and write its accounts under ``path``, a folder per batch.

    They are written after the batch is committed, so a driver that is lost in between leaves a batch without an account, never a wrong one.
    A query remembers its last 100 batches: ``every_seconds`` must be less than they take.
    """
    written: set[int] = set()

    def write() -> None:
        for row in accounts(query):
            if row[0] not in written:
                spark.createDataFrame([row], ACCOUNT).drop("batch").coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={row[0]}")
                written.add(row[0])

    try:
        while not query.awaitTermination(every_seconds):
            write()
    finally:
        if query.isActive:
            query.stop()
        write()


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    """The accounts so far; no rows before the first."""
    return spark.read.schema(ACCOUNT).option("basePath", path).parquet(path) if exists(spark, path) else spark.createDataFrame([], ACCOUNT)
