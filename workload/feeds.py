"""Click events from the supplied ``events`` and ``part`` tables.

product_id is the number in ``props``; its category is the part's type. ``topic`` writes the events as messages, some of
them broken the way real feeds are: value > 150 is no JSON, value < 1 has no readable time, sign-ups have no product and
no category, cheap clicks (value < 3) have an empty category.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clicklake.functions.time import iso_text
from clicklake.operators.conversion import enrich_category
from clicklake.plans.catalogue import used_catalogue as reduce_catalogue
from clicklake.session import scratch_dir
from clicklake.sources import sinks
from clicklake.sources.files import lake_path, read_messages
from clicklake.streaming.archive import archive_rows

_written: dict[tuple[str, str, str], str] = {}


# Given schemas spare every query the job that would read a footer.
_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def click_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.to_date("ts").alias("event_date"),
        "user_id",
        "event_type",
        F.get_json_object("props", "$.k").alias("product_id"),
        "value",
    )


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"), F.col("p_type").alias("category"), "p_size"
    )


def used_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the catalogue that events refer to."""
    whole = catalogue(spark, sf_dir)
    path = _once(spark, sf_dir, "catalogue", lambda path: reduce_catalogue(click_events(spark, sf_dir), whole, path))
    return spark.read.schema(whole.schema).parquet(path)


def stocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue without its oversized parts, so that some products are in no category."""
    return without_oversized(catalogue(spark, sf_dir))


def without_oversized(parts: DataFrame) -> DataFrame:
    return parts.where(F.col("p_size") <= 40)


def categorised_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_category(click_events(spark, sf_dir), used_catalogue(spark, sf_dir), fallback=None)


def _once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Write a derived feed once per application and give its folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = scratch_dir(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    signup = F.col("event_type") == "signup"
    cheap_click = (F.col("event_type") == "click") & (F.col("value") < 3)
    fields = F.struct(
        "event_id",
        "user_id",
        F.when(~signup, F.col("product_id")).alias("product_id"),
        "event_type",
        F.when(cheap_click, "").when(~signup, F.col("category")).alias("category"),
        F.when(F.col("value") < 1, "some day").otherwise(iso_text("event_time")).alias("timestamp"),
    )
    return categorised_events(spark, sf_dir).select(
        F.when(F.col("value") > 150, "not json").otherwise(F.to_json(fields)).alias("value")
    )


def topic(spark: SparkSession, sf_dir: str) -> str:
    """Folder of message text, the file form of the topic."""
    return _once(spark, sf_dir, "topic", lambda path: messages(spark, sf_dir).write.text(path))


def lake(spark: SparkSession, sf_dir: str) -> str:
    """Root of a lake archived from the topic in one batch."""

    def write(root: str) -> None:
        rows = archive_rows(read_messages(spark, topic(spark, sf_dir)))
        sinks.write_table(rows, lake_path(root), day="event_date")

    return _once(spark, sf_dir, "lake", write)


ARRIVALS = ("2024-01-08", "2024-01-15", "2024-01-22")
REPEATS = ((5, 0), (7, 1), (11, 3))  # every so manieth event, how many weeks later


def _week() -> Column:
    return sum((F.to_date("event_time") >= F.lit(day).cast("date")).cast("int") for day in ARRIVALS)


def _wire_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages with the number of the week, 0 to 3, that they belong to."""
    return _wire(click_events(spark, sf_dir).withColumn("week", _week()), "event_id")


def _wire(events: DataFrame, event_id: str, *more: str) -> DataFrame:
    fields = F.struct(F.col(event_id).alias("event_id"), "user_id", "product_id", "event_type", *more, iso_text("event_time").alias("timestamp"))
    return events.withColumn("value", F.to_json(fields))


def arrivals(spark: SparkSession, sf_dir: str, late: bool) -> list[DataFrame]:
    """The messages in the parts that arrive one after the other: by week and, if asked, every third purchase a week late."""
    return _parts_by_week(_wire_by_week(spark, sf_dir), late)


def labelled_arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Those with late purchases, and with the product's category on each message."""
    events = categorised_events(spark, sf_dir).withColumn("week", _week())
    return _parts_by_week(_wire(events, "event_id", "category"), late=True)


def _parts_by_week(wire: DataFrame, late: bool) -> list[DataFrame]:
    delayed = (F.col("event_type") == "purchase") & (F.col("event_id") % 3 == 0)
    part = F.col("week") + F.when(delayed, 1).otherwise(0) if late else F.col("week")
    rows = wire.withColumn("part", part)
    return [rows.where(F.col("part") == k).select("value") for k in range(len(ARRIVALS) + 1 + late)]


def deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The messages by week, some of them delivered again: every fifth at once, every seventh a week later, every eleventh three weeks later."""
    again = [F.when(F.col("event_id") % every == 0, F.col("week") + weeks) for every, weeks in REPEATS]
    rows = _wire_by_week(spark, sf_dir).select("value", F.explode(F.array_compact(F.array("week", *again))).alias("part"))
    return [rows.where(F.col("part") == k).select("value") for k in range(len(ARRIVALS) + 1 + max(weeks for _, weeks in REPEATS))]


def numbered_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with their arrival numbers; purchases arrive some fifty events late."""
    late = F.when(F.col("event_type") == "purchase", 505).otherwise(0)
    return click_events(spark, sf_dir).withColumn("arrival", F.col("event_id") * 10 + late)


def by_arrival(spark: SparkSession, sf_dir: str, parts: int = 4) -> list[DataFrame]:
    """These as messages, the arrival number as their id, in parts that arrive one after the other."""
    rows = _wire(numbered_arrivals(spark, sf_dir), "arrival")
    last = rows.agg(F.max("arrival").alias("last")).first()["last"] or 0
    part = F.floor(F.col("arrival") * parts / F.lit(last + 1))
    return [rows.where(part == k).select("value") for k in range(parts)]


RENAMED, RENAMING_DAYS, LEAVING = "2024-01-01 12:00:00", 20, "6 days"


def dated_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part is known by its type, and from some day in January on by its brand; oversized parts leave six days after that."""
    parts = table(spark, sf_dir, "part")
    renamed = F.lit(RENAMED).cast("timestamp_ntz") + F.make_dt_interval(F.col("p_partkey") % RENAMING_DAYS)
    never = F.lit(None).cast("timestamp_ntz")
    product = F.col("p_partkey").cast("string").alias("product_id")
    first = parts.select(product, F.col("p_type").alias("category"), never.alias("valid_from"), never.alias("valid_to"))
    left = F.when(F.col("p_size") > 40, renamed + F.expr(f"interval {LEAVING}"))
    return first.unionByName(parts.select(product, F.col("p_brand").alias("category"), renamed.alias("valid_from"), left.alias("valid_to")))
