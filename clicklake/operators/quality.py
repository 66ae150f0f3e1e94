"""Data-quality counts: every check is a query over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clicklake.functions.time import parsed_time
from clicklake.operators.conversion import unique_products


def missing_fields(events: DataFrame, fields: list[str]) -> DataFrame:
    """(field, missing) for each required field, in one pass."""
    return events.agg(*[F.count_if(F.col(f).isNull()).alias(f) for f in fields]).unpivot([], fields, "field", "missing")


def outside_range(column: str, low: int | float, high: int | float) -> Column:
    """The number, which may be held as text, lies outside the closed range; text that is no number does too."""
    number = F.col(column).try_cast("double")
    return F.col(column).isNotNull() & ~F.coalesce(number.between(low, high), F.lit(False))


def outside_set(column: str, allowed: list) -> Column:
    return ~F.col(column).isin(allowed)


def bad_time(text: str, first: str, last: str) -> Column:
    """The text is no timestamp, or lies outside the range."""
    time = parsed_time(text)
    inside = time.between(F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp"))
    return F.col(text).isNotNull() & ~F.coalesce(inside, F.lit(False))


def rule_counts(events: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, violations) for any number of row rules, in one pass; a NULL is no violation, ``missing_fields`` counts those."""
    return events.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()]).unpivot(
        [], list(rules), "rule", "violations"
    )


def unknown_products(events: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Products (with their number of events) that the catalogue does not list.

    An outer join, since Catalyst moves an anti join with a broadcast side below the count, where it meets every event.
    """
    counts = events.groupBy("product_id").agg(F.count("*").alias("events"))
    listed = catalogue.select("product_id").distinct().withColumn("listed", F.lit(True))
    return counts.join(listed, "product_id", "left").where(F.col("listed").isNull()).drop("listed")


def duplicate_ids(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Keys seen more than once; NULL is a key like any other here, and ``missing_fields`` counts it by itself."""
    return events.groupBy(key).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def category_mismatches(events: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Categories seen on events that differ from the catalogue's for the same product; events are counted before the join."""
    seen = events.groupBy("product_id", "category").agg(F.count("*").alias("events"))
    expected = unique_products(catalogue).withColumnRenamed("category", "expected_category")
    return seen.join(expected, "product_id").where(~F.col("category").eqNullSafe(F.col("expected_category")))


def order_violations(events: DataFrame, arrival: str = "event_id", time: str = "event_time", chunk: int = 1_000_000) -> DataFrame:
    """Per user: events, and how many lie before the event that arrived just ahead of them."""
    return order_per_user(events, arrival, time, chunk).select("user_id", "events", "violations")


def order_per_user(events: DataFrame, arrival: str = "event_id", time: str = "event_time", chunk: int = 1_000_000) -> DataFrame:
    """The same, with the times of the user's first and last arrival (``head``, ``tail``) and the latest time of all (``seen``).

    ``arrival`` is an integer that grows with arrival; events without one are one arrival, before the others. Events are shuffled once, by
    (user, chunk of arrival numbers): there copies of one arrival are merged, and arrivals compared, so no task orders more than
    ``chunk`` arrivals of a user; last, the chunks' edges are compared. The result is that of one ordering per user.
    """
    narrow = events.select("user_id", F.floor(F.col(arrival) / F.lit(chunk)).alias("chunk"), F.col(arrival).alias("arrival"), F.col(time).alias("at"))
    arrivals = narrow.repartition("user_id", "chunk").groupBy("user_id", "chunk", "arrival").agg(
        F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("copies")
    )
    in_chunk = Window.partitionBy("user_id", "chunk").orderBy("arrival")
    compared = arrivals.withColumn("before", F.lag("last").over(in_chunk)).withColumn(
        "opens", F.row_number().over(in_chunk) == 1
    ).withColumn("closes", F.lead(F.lit(1)).over(in_chunk).isNull())
    chunks = compared.groupBy("user_id", "chunk").agg(
        F.sum("copies").alias("events"),
        F.count_if(F.col("first") < F.col("before")).alias("inner"),
        F.min(F.when(F.col("opens"), F.col("first"))).alias("head"),
        F.max(F.when(F.col("closes"), F.col("last"))).alias("tail"),
        F.max("last").alias("seen"),
    )
    across = Window.partitionBy("user_id").orderBy("chunk")
    return (
        chunks.withColumn("edge", (F.col("head") < F.lag("tail").over(across)).cast("int"))
        .withColumn("n", F.row_number().over(across))
        .groupBy("user_id")
        .agg(
            F.sum("events").alias("events"),
            F.sum(F.col("inner") + F.coalesce("edge", F.lit(0))).alias("violations"),
            F.min_by("head", "n").alias("head"),
            F.max_by("tail", "n").alias("tail"),
            F.max("seen").alias("seen"),
        )
    )
