"""Daily views and purchases, by user and by category, kept up to date by a stream.

A batch counts its own events and merges them into the totals of the days it touches, not of the others. A day's totals are written to a
folder of the batch's number and never changed; a manifest per batch, written last, names each day's folder. So a reader sees a batch
whole or not at all, and a batch that is run again starts from the manifest before it, replaces what it wrote and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clicklake import schema as S
from clicklake.functions.metrics import views_and_purchases
from clicklake.operators.activity import rolled_up
from clicklake.operators.conversion import with_conversion_rate
from clicklake.operators.decode import archivable, decode_events, with_event_date
from clicklake.sources.files import file_system, whole_batches
from clicklake.streaming.run import triggered

BY = ("user_id", "category")
COUNTS = "event_date date, by string, key string, views bigint, purchases bigint"
_MANIFEST = "event_date date, folder bigint"


def batch_counts(events: DataFrame) -> DataFrame:
    """(event_date, by, key, views, purchases) for users and for categories, from one pass; a NULL user or category is a key too."""
    sets = [["event_date", key] for key in BY]
    counts = events.groupingSets(sets, "event_date", *BY).agg(F.grouping(BY[0]).alias("coarse"), *views_and_purchases())
    by_user = F.col("coarse") == 0
    by, key = F.when(by_user, BY[0]).otherwise(BY[1]).alias("by"), F.when(by_user, F.col(BY[0])).otherwise(F.col(BY[1])).alias("key")
    return counts.select("event_date", by, key, "views", "purchases")


def _manifest(spark: SparkSession, root: str, batch: int) -> dict:
    """Each day's folder after a batch: a row per day there is."""
    if batch < 0:
        return {}
    found = spark.read.schema(_MANIFEST).parquet(f"{root}/manifests/batch={batch}").collect()
    return {row["event_date"]: row["folder"] for row in found}


def _read(spark: SparkSession, root: str, folders: dict) -> DataFrame:
    paths = [f"{root}/totals/batch={folder}/event_date={day}" for day, folder in sorted(folders.items())]
    if not paths:
        return spark.createDataFrame([], COUNTS)
    return spark.read.schema(COUNTS).option("basePath", f"{root}/totals").parquet(*paths).select("event_date", "by", "key", "views", "purchases")


def _merge_batch(events: DataFrame, batch: int, root: str) -> None:
    spark = events.sparkSession
    path = f"{root}/counts/batch={batch}"
    batch_counts(events).write.mode("overwrite").parquet(path)
    counts = spark.read.schema(COUNTS).parquet(path)
    before = _manifest(spark, root, last_totals(spark, root, batch))
    touched = {row["event_date"] for row in counts.select("event_date").distinct().collect()}  # days, not rows
    held = _read(spark, root, {day: folder for day, folder in before.items() if day in touched})
    totals = rolled_up(held.unionByName(counts), "event_date", "by", "key").hint("rebalance", "event_date", "by")
    totals.write.mode("overwrite").partitionBy("event_date", "by").parquet(f"{root}/totals/batch={batch}")
    after = sorted((before | dict.fromkeys(touched, batch)).items())
    spark.createDataFrame(after, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{root}/manifests/batch={batch}")


def start_daily_totals(messages: DataFrame, root: str, every: str | None = S.ALERT_TRIGGER, name: str = "daily-totals") -> StreamingQuery:
    """Keep the totals of a stream of messages under ``root``; the checkpoint lies beside them. Events without a readable time have no day."""
    events = with_event_date(archivable(decode_events(messages, "user_id", "event_type", "category", "timestamp")))
    writer = events.writeStream.queryName(name).option("checkpointLocation", f"{root}/{S.CHECKPOINTS}/{name}")
    return triggered(writer.foreachBatch(lambda rows, batch: _merge_batch(rows, batch, root)), every).start()


def last_totals(spark: SparkSession, root: str, before: int | None = None) -> int:
    """The newest batch, or the newest below ``before``, whose manifest is whole; -1 if there is none."""
    return max((b for b in whole_batches(spark, f"{root}/manifests") if before is None or b < before), default=-1)


def _totals(spark: SparkSession, root: str, by: str) -> DataFrame:
    found = _read(spark, root, _manifest(spark, root, last_totals(spark, root)))
    return found.where(F.col("by") == by).select("event_date", F.col("key").alias(by), "views", "purchases")


def daily_user_totals(spark: SparkSession, root: str) -> DataFrame:
    """``operators.activity.daily_user_activity`` of all batches up to the last whole one."""
    return _totals(spark, root, "user_id")


def daily_category_totals(spark: SparkSession, root: str) -> DataFrame:
    """``operators.conversion.category_conversion`` by day, of the same batches."""
    return with_conversion_rate(_totals(spark, root, "category"))


def drop_old_totals(spark: SparkSession, root: str, keep: int = 10) -> list[str]:
    """Delete the days' folders that none of the newest ``keep`` manifests names; a reader older than those batches loses its files.

    The batches' own counts go with them, and older manifests too. Nothing that a batch still has to read is deleted, however few are kept.
    """
    whole = sorted(whole_batches(spark, f"{root}/manifests"))
    kept = whole[-max(keep, 2) :]
    if not kept:
        return []
    named = {(folder, f"event_date={day}") for batch in kept for day, folder in _manifest(spark, root, batch).items()}
    gone = []
    for batch in whole:
        if batch < kept[0]:
            gone += [f"{root}/counts/batch={batch}", f"{root}/manifests/batch={batch}"]
        system, at = file_system(spark, f"{root}/totals/batch={batch}")
        if batch <= kept[-1] and system.exists(at):
            days = [status.getPath().getName() for status in system.listStatus(at) if status.isDirectory()]
            gone += [f"{root}/totals/batch={batch}/{day}" for day in days if (batch, day) not in named]
    gone = [path for path in gone if file_system(spark, path)[0].delete(file_system(spark, path)[1], True)]
    return gone
