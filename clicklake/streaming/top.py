"""The most viewed products of a stream, exactly, from a summary of bounded size.

Each batch's views are counted per product and stored. Beside them a Space-Saving summary is kept: products are spread over buckets, and
a bucket holds its ``counters`` largest counts. A product that was not held enters with the bucket's floor, the most that any product
dropped from it may have had, on top of its own views; the floor is its error. So a held count is never too low, and at most its error too high, and
a product that is not held has no more views than the floor.

Reading the top k takes as candidates the products that could be among the k best. If these bounds prove that no other product can be,
only the candidates' stored counts are summed, and if none of them has an error, nothing is; else all stored counts are.

A batch writes folders of its own number and reads the summary of the batch before, so a batch that is run again replaces what it wrote.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from clicklake import schema as S
from clicklake.operators.activity import product_view_counts
from clicklake.operators.decode import decode_events
from clicklake.sources.files import exists, whole_batches
from clicklake.streaming.run import triggered

COUNTS = "product_id string, view_count bigint"
SUMMARY = "bucket bigint, product_id string, view_count bigint, error bigint, floor bigint"


@dataclass(frozen=True)
class SummarySize:
    """Buckets bound the parallelism of a merge, counters the size of a bucket. A root keeps the size it was started with."""

    buckets: int = 64
    counters: int = 1000


def _most_viewed() -> list[Column]:
    return [F.desc("view_count"), F.asc("product_id")]


def merged(held: DataFrame, counts: DataFrame, size: SummarySize) -> DataFrame:
    """The summary ``held`` and the counts of one more batch as one summary."""
    bucket = F.pmod(F.xxhash64("product_id"), F.lit(size.buckets)).alias("bucket")
    fresh = counts.select(bucket, "product_id", "view_count", F.lit(0).cast("bigint").alias("error"), F.lit(False).alias("held"))
    both = held.select("bucket", "product_id", "view_count", "error", F.lit(True).alias("held")).unionByName(fresh)
    summed = both.groupBy("bucket", "product_id").agg(F.sum("view_count").alias("view_count"), F.max("error").alias("error"), F.max("held").alias("held"))
    floors = held.groupBy("bucket").agg(F.max("floor").alias("before"))
    entry = F.when(F.col("held"), 0).otherwise(F.coalesce("before", F.lit(0))).cast("bigint")
    entered = summed.join(floors, "bucket", "left").select(
        "bucket", "product_id", (F.col("view_count") + entry).alias("view_count"), (F.col("error") + entry).alias("error"), F.coalesce("before", F.lit(0)).alias("before")
    )
    # One more than the counters: the largest count that is dropped is the new floor. Each task limits its own rows before the shuffle.
    ranked = entered.withColumn("n", F.row_number().over(Window.partitionBy("bucket").orderBy(*_most_viewed()))).where(F.col("n") <= size.counters + 1)
    dropped = F.max(F.when(F.col("n") > size.counters, F.col("view_count"))).over(Window.partitionBy("bucket"))
    floor = F.greatest("before", dropped).cast("bigint").alias("floor")
    return ranked.select("bucket", "product_id", "view_count", "error", floor, "n").where(F.col("n") <= size.counters).drop("n")


def _summary(spark: SparkSession, root: str, batch: int) -> DataFrame:
    path = f"{root}/summary/batch={batch}"
    return spark.read.schema(SUMMARY).parquet(path) if batch >= 0 and exists(spark, path) else spark.createDataFrame([], SUMMARY)


def _count_batch(events: DataFrame, batch: int, root: str, size: SummarySize) -> None:
    spark = events.sparkSession
    path = f"{root}/counts/batch={batch}"
    # Sorted, so that the candidates' counts are few row groups of a file.
    product_view_counts(events).sortWithinPartitions("product_id").write.mode("overwrite").parquet(path)
    summary = merged(_summary(spark, root, batch - 1), spark.read.schema(COUNTS).parquet(path), size)
    summary.write.mode("overwrite").parquet(f"{root}/summary/batch={batch}")


def start_top_products(
    messages: DataFrame, root: str, every: str | None = S.ALERT_TRIGGER, size: SummarySize = SummarySize(), name: str = "top-products"
) -> StreamingQuery:
    """Keep counts and summary of a stream of messages under ``root``; the checkpoint lies beside them."""
    events = decode_events(messages, "product_id", "event_type")
    writer = events.writeStream.queryName(name).option("checkpointLocation", f"{root}/{S.CHECKPOINTS}/{name}")
    return triggered(writer.foreachBatch(lambda rows, batch: _count_batch(rows, batch, root, size)), every).start()


def last_batch(spark: SparkSession, root: str) -> int:
    """The newest batch whose summary is whole; -1 if there is none. Batches are numbered without gaps."""
    return max(whole_batches(spark, f"{root}/summary"), default=-1)


def candidates(summary: DataFrame, k: int) -> tuple[DataFrame, bool, bool]:
    """(the held products that may be among the k most viewed, whether no other product can be, whether their counts are exact)."""
    sure = (F.col("view_count") - F.col("error")).alias("sure")
    best = [r["sure"] for r in summary.select(sure).orderBy(F.desc("sure")).limit(k).collect()]  # k numbers
    needed = best[-1] if len(best) == k else 0
    possible = summary.where(F.col("view_count") >= needed)
    bounds = summary.agg(F.max("floor").alias("floor"), F.max(F.when(F.col("view_count") >= needed, F.col("error"))).alias("error")).first()
    floor = bounds["floor"] or 0
    return possible, floor == 0 or floor < needed, not bounds["error"]


def stored_counts(spark: SparkSession, root: str, batch: int) -> DataFrame:
    """The counts of all batches up to this one."""
    path = f"{root}/counts"
    return spark.read.schema(f"{COUNTS}, batch int").option("basePath", path).parquet(path).where(F.col("batch") <= batch).drop("batch")


def top_products_so_far(spark: SparkSession, root: str, k: int = S.TOP_K) -> DataFrame:
    """``operators.products.top_products`` of all batches up to the last whole one; NULL is a product like any other."""
    batch = last_batch(spark, root)
    possible, proven, exact = candidates(_summary(spark, root, batch), k)
    if proven and exact:
        counts = possible.select("product_id", "view_count")
    else:
        stored = stored_counts(spark, root, batch)
        if proven:
            names = possible.select(F.col("product_id").alias("candidate"))
            stored = stored.join(names, F.col("product_id").eqNullSafe(F.col("candidate")), "left_semi")
        counts = stored.groupBy("product_id").agg(F.sum("view_count").alias("view_count"))
    return counts.orderBy(*_most_viewed()).limit(k)
