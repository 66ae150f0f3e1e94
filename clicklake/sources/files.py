"""Event files: JSON and message-text directories, and the date-partitioned Parquet lake."""

from __future__ import annotations

from datetime import date

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from clicklake import schema as S
from clicklake.functions.time import as_day


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # Spark's directory name for a null


def read_json_events(spark: SparkSession, path: str, schema: StructType = S.EVENT_SCHEMA) -> DataFrame:
    """JSON-lines directory; the given schema saves the pass over the data that inference would need."""
    return spark.read.schema(schema).json(path)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """A dumped topic: one message per line, in ``value``."""
    return spark.read.text(path)


def stream_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def lake_path(root: str) -> str:
    return f"{root.rstrip('/')}/{S.RAW_EVENTS}"


def file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The Hadoop file system that holds a path, and the path."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    system, at = file_system(spark, path)
    return system.exists(at)


def whole_batches(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the folders ``batch=N`` below a path that were written to their end."""
    system, at = file_system(spark, path)
    if not system.exists(at):
        return []
    names = [status.getPath().getName() for status in system.listStatus(at)]
    numbers = [int(n.removeprefix("batch=")) for n in names if n.startswith("batch=")]
    return [n for n in numbers if exists(spark, f"{path}/batch={n}/_SUCCESS")]


def days_below(spark: SparkSession, path: str, day: str) -> dict[date, str]:
    """The day directories right below a path, by day, from one listing that does not descend. The directory of rows without a
    day is none of them."""
    system, at = file_system(spark, path)
    if not system.exists(at):
        return {}
    names = [s.getPath().getName() for s in system.listStatus(at)]
    named = {n: n.removeprefix(f"{day}=") for n in names if n.startswith(f"{day}=")}
    return {as_day(d): f"{path.rstrip('/')}/{n}" for n, d in named.items() if d != NO_VALUE}


def is_stream_written(spark: SparkSession, path: str) -> bool:
    """Whether a stream wrote the folder, which Spark then reads through the stream's log."""
    system, at = file_system(spark, f"{path.rstrip('/')}/_spark_metadata")
    return system.exists(at)


def read_lake(
    spark: SparkSession,
    root: str,
    first: date | str | None = None,
    last: date | str | None = None,
    schema: StructType = S.LAKE_SCHEMA,
) -> DataFrame:
    """The lake between two days (both included); a day that was never written just has no rows, a bound that is no day raises.

    With a range, the directories of its days alone are listed; a root written by a stream is read through the stream's log, which
    lists the files itself. Only ``*.parquet`` files are read, and the given schema spares the driver from opening footers.
    """
    path = lake_path(root)
    low, high = (None if d is None else as_day(d) for d in (first, last))
    reader = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").option("basePath", path)
    if low is None and high is None or is_stream_written(spark, path):
        events = reader.parquet(path)
    else:
        known = days_below(spark, path, "event_date")
        wanted = [at for d, at in sorted(known.items()) if (low is None or d >= low) and (high is None or d <= high)]
        events = reader.parquet(*wanted) if wanted else spark.createDataFrame([], schema)
    if low is not None:
        events = events.where(F.col("event_date") >= F.lit(low))
    if high is not None:
        events = events.where(F.col("event_date") <= F.lit(high))
    return events
