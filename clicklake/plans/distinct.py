"""Distinct users and products over any range of days, from sketches stored per day.

Exact distinct counts of a range need its events again. A HyperLogLog sketch of a day is a few KB whatever the day holds, and sketches of days
unite to that of their range, so a range costs one small row per day. Records are summed, and are exact.
"""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from clicklake.functions.time import as_day
from clicklake.sources import sinks

LOG_SIZE = 14
SKETCH_SCHEMA = "records bigint, products binary, users binary, report_date date"


def relative_error(log_size: int = LOG_SIZE) -> float:
    """Three standard errors of an estimate, as a share of the true count."""
    return 3 * 1.04 / math.sqrt(1 << log_size)


def daily_sketches(counts: DataFrame, users: DataFrame, log_size: int = LOG_SIZE) -> DataFrame:
    """One row per day from the daily counts (report_date, product_id, events) and the daily users (report_date, user_id): both are
    grouped already, so no event is read. NULL is not counted as a product or a user."""
    products = counts.groupBy(sinks.DAY).agg(
        F.sum("events").alias("records"), F.hll_sketch_agg(F.col("product_id").cast("string"), log_size).alias("products")
    )
    people = users.groupBy(sinks.DAY).agg(F.hll_sketch_agg(F.col("user_id").cast("string"), log_size).alias("users"))
    return products.join(people, sinks.DAY).select("records", "products", "users", sinks.DAY)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SKETCH_SCHEMA).option("basePath", path).parquet(path)


def statistics_over(sketches: DataFrame, ranges: list[tuple[date | str, date | str]]) -> DataFrame:
    """(first_day, last_day, days, records_processed, unique_products, unique_users) of each range of days, both ends included; the last two
    are estimates. A range without any stored day has a row of zeros; ranges may overlap or repeat."""
    spark = sketches.sparkSession
    bounds = sorted({(as_day(a), as_day(b)) for a, b in ranges})
    asked = spark.createDataFrame(bounds, "first_day date, last_day date")
    every = F.explode(F.when(F.col("first_day") <= F.col("last_day"), F.sequence("first_day", "last_day"))).alias(sinks.DAY)
    found = asked.select("first_day", "last_day", every).join(sketches, sinks.DAY)
    united = found.groupBy("first_day", "last_day").agg(
        F.count("*").alias("days"),
        F.sum("records").alias("records_processed"),
        F.hll_sketch_estimate(F.hll_union_agg("products")).alias("unique_products"),
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("unique_users"),
    )
    numbers = ["days", "records_processed", "unique_products", "unique_users"]
    return asked.join(united, ["first_day", "last_day"], "left").na.fill(0, numbers)
