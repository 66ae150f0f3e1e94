"""Messages to the date-partitioned Parquet lake. Narrow: no shuffle and no state; ``streaming.once`` leaves repeated deliveries out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from clicklake import schema as S
from clicklake.operators.decode import archivable, decode_events, with_event_date
from clicklake.sources.files import lake_path
from clicklake.streaming.run import triggered


def archive_rows(messages: DataFrame) -> DataFrame:
    return with_event_date(archivable(decode_events(messages)))


def append_to_lake(rows: DataFrame, root: str, every: str | None, name: str, checkpoint: str | None = None) -> StreamingQuery:
    """Append a stream of lake rows to the lake under ``root``; the checkpoint lies beside the data."""
    writer = (
        rows.writeStream.format("parquet")
        .queryName(name)
        .outputMode("append")
        .partitionBy("event_date")
        .option("path", lake_path(root))
        .option("checkpointLocation", checkpoint or f"{root.rstrip('/')}/{S.CHECKPOINTS}/{name}")
    )
    return triggered(writer, every).start()


def start_archive(
    messages: DataFrame, root: str, every: str | None = S.ARCHIVE_TRIGGER, name: str = "raw-event-archive", checkpoint: str | None = None
) -> StreamingQuery:
    """Append every event with a readable time to the lake under ``root``."""
    return append_to_lake(archive_rows(messages), root, every, name, checkpoint)
