"""Starting streaming queries and waiting for them."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """A processing-time trigger, or with None one run over all that is available (backfill)."""
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


def wait(query: StreamingQuery, timeout: float | None = None) -> bool | None:
    """Block until the query ends; its failure is raised, and on any exit it is stopped rather than left running."""
    try:
        return query.awaitTermination(timeout) if timeout is not None else query.awaitTermination()
    finally:
        if query.isActive:
            query.stop()
