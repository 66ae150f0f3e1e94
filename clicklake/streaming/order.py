"""Arrival order on a stream: how many events of a user lie before the one that arrived just ahead, over all batches.

A batch is compared within itself as a table is, chunk by chunk, which leaves one row per user; only these meet the users' last times
of the batch before. The last times are kept for as long as the time-to-live, in event time: a user who was silent for longer is new. What a
batch found is stored under its number, and its last times too, so that a batch that is run again replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clicklake import schema as S
from clicklake.operators.quality import order_per_user
from clicklake.sources.files import whole_batches
from clicklake.streaming.run import triggered

FOUND = "user_id string, events bigint, violations bigint"
LAST = "user_id string, tail timestamp, seen timestamp"


def _read(spark: SparkSession, root: str, part: str, schema: str, batch: int) -> DataFrame:
    path = f"{root}/{part}/batch={batch}"
    return spark.read.schema(schema).parquet(path) if batch >= 0 else spark.createDataFrame([], schema)


def compared(users: DataFrame, last: DataFrame) -> DataFrame:
    """One row per user of the batch or of the state, with what the batch found, its edge to the batch before included.

    At most two rows of a user meet. A user who is not in the batch has no ``events``.
    """
    none = F.lit(None)
    held = last.select("user_id", F.lit(0).alias("part"), none.cast("bigint").alias("events"), none.cast("bigint").alias("violations"),
                       none.cast("timestamp").alias("head"), "tail", "seen")
    fresh = users.select("user_id", F.lit(1).alias("part"), "events", "violations", "head", "tail", "seen")
    before = F.max(F.when(F.col("part") == 0, F.col("tail")))
    edge = F.coalesce((F.max("head") < before).cast("int"), F.lit(0))
    return held.unionByName(fresh).groupBy("user_id").agg(
        F.sum("events").alias("events"),
        (F.sum("violations") + edge).alias("violations"),
        F.max_by("tail", "part").alias("tail"),
        F.max("seen").alias("seen"),
    )


def _compare_batch(events: DataFrame, batch: int, root: str, arrival: str, time: str, chunk: int, keep_seconds: int | None) -> None:
    spark = events.sparkSession
    path = f"{root}/users/batch={batch}"
    order_per_user(events, arrival, time, chunk).write.mode("overwrite").parquet(path)
    users = spark.read.schema(f"{FOUND}, head timestamp, tail timestamp, seen timestamp").parquet(path)
    last = _read(spark, root, "last", LAST, max((b for b in whole_batches(spark, f"{root}/last") if b < batch), default=-1))
    rows = compared(users, last)
    rows.where(F.col("events").isNotNull()).select("user_id", "events", "violations").write.mode("overwrite").parquet(f"{root}/found/batch={batch}")
    if keep_seconds is not None:
        now = users.select("seen").unionByName(last.select("seen")).agg(F.max("seen").alias("now")).first()["now"]
        rows = rows.where(F.col("seen") >= F.lit(now).cast("timestamp") - F.make_dt_interval(secs=F.lit(keep_seconds)))
    rows.select("user_id", "tail", "seen").write.mode("overwrite").parquet(f"{root}/last/batch={batch}")


def start_order_check(
    events: DataFrame,
    root: str,
    arrival: str = "event_id",
    time: str = "event_time",
    every: str | None = S.ALERT_TRIGGER,
    keep_seconds: int | None = 7 * 86_400,
    chunk: int = 1_000_000,
    name: str = "order-check",
) -> StreamingQuery:
    """Check a stream of decoded events and keep what is found under ``root``; the checkpoint lies beside it.

    ``arrival`` is an integer, or text of one, that grows with arrival, from batch to batch too: a message's offset where a user's messages
    share a topic partition. ``keep_seconds`` bounds the last times by the users seen within it; None keeps every user's. A user without
    any event time has no last time worth keeping and is dropped by the bound.
    """
    rows = events.select(F.col("user_id").cast("string").alias("user_id"), F.col(arrival).try_cast("bigint").alias(arrival), time)
    writer = rows.writeStream.queryName(name).option("checkpointLocation", f"{root}/{S.CHECKPOINTS}/{name}")
    step = lambda batch, number: _compare_batch(batch, number, root, arrival, time, chunk, keep_seconds)
    return triggered(writer.foreachBatch(step), every).start()


def order_violations_so_far(spark: SparkSession, root: str) -> DataFrame:
    """``operators.quality.order_violations`` of all batches up to the last whole one."""
    last = max(whole_batches(spark, f"{root}/last"), default=-1)
    if last < 0:
        return spark.createDataFrame([], FOUND)
    found = spark.read.schema(f"{FOUND}, batch int").option("basePath", f"{root}/found").parquet(f"{root}/found").where(F.col("batch") <= last)
    return found.groupBy("user_id").agg(F.sum("events").alias("events"), F.sum("violations").alias("violations"))
