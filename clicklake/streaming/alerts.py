"""Flash-sale alerts from a stream of messages: each window is judged once, after the watermark has passed its end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from clicklake import schema as S
from clicklake.operators.alerts import flash_sale_alerts
from clicklake.operators.decode import alertable, decode_events
from clicklake.sources.kafka import as_messages
from clicklake.streaming.run import triggered


def alert_rows(messages: DataFrame, rule: S.AlertRule = S.AlertRule(), delay: str = S.WATERMARK_DELAY) -> DataFrame:
    """Decode, keep what can be counted, and detect; on a table the watermark has no effect."""
    return flash_sale_alerts(alertable(decode_events(messages)).withWatermark("event_time", delay), rule)


def alert_writer(alerts: DataFrame, checkpoint: str, sink: str, name: str = "flash-sale-alerts", **options: str) -> DataStreamWriter:
    """Append writer. Message sinks ("kafka", "text") get one JSON document per alert, other sinks the columns."""
    rows = as_messages(alerts) if sink in ("kafka", "text") else alerts
    return (
        rows.writeStream.queryName(name)
        .outputMode("append")
        .format(sink)
        .options(**options)
        .option("checkpointLocation", checkpoint)
    )


def start_alerts(writer: DataStreamWriter, every: str | None = S.ALERT_TRIGGER) -> StreamingQuery:
    return triggered(writer, every).start()
