"""What a stream's checkpoint holds: its stateful operators, and the alert windows that are still open."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_KEY = "struct<span: struct<start: timestamp, end: timestamp>, product_id: string>"
_VALUE = "struct<views: bigint, purchases: bigint>"


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(operator, name, state_partitions, first_batch, last_batch) of each stateful operator."""
    found = spark.read.format("state-metadata").load(checkpoint)
    columns = {"operatorId": "operator", "operatorName": "name", "numPartitions": "state_partitions", "minBatchId": "first_batch", "maxBatchId": "last_batch"}
    return found.select(*[F.col(old).alias(new) for old, new in columns.items()])


def open_windows(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """(start, end, product_id, views, purchases) of the alert windows that have not been judged, as the state has them.

    The state is read partition by partition on the executors; the stream may run meanwhile. ``batch`` asks for the state after
    an earlier batch, as long as the checkpoint keeps it; the last committed one is read if it is None.
    """
    reader = spark.read.format("statestore").option("operatorId", 0)
    state = (reader if batch is None else reader.option("batchId", batch)).load(checkpoint)
    # The state names its fields as the plan did, the two counts alike; casts go by position.
    key, value = F.col("key").cast(_KEY), F.col("value").cast(_VALUE)
    span = key.getField("span")
    counts = [value.getField(name).alias(name) for name in ("views", "purchases")]
    return state.select(span.getField("start").alias("start"), span.getField("end").alias("end"), key.getField("product_id").alias("product_id"), *counts)
