"""Kafka endpoints. Every transform only needs a ``value`` column, so files serve as well as topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def source_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = True,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options. Offsets that aged out of the topic fail the stream unless ``fail_on_data_loss`` is off. ``min_partitions`` splits a topic with few or hot partitions over more tasks."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def sink_options(servers: str, topic: str, checkpoint: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "checkpointLocation": checkpoint,
    }


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def as_messages(rows: DataFrame) -> DataFrame:
    """One JSON document per row, in the ``value`` column a message sink expects."""
    return rows.select(F.to_json(F.struct("*")).alias("value"))
