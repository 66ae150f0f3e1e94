"""Cutting a large catalogue down to the products that occur."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clicklake.session import scratch_dir


def used_catalogue(events: DataFrame, catalogue: DataFrame, path: str | None = None) -> DataFrame:
    """The catalogue rows of products that occur in ``events``, written and read back.

    For labelling every event from a catalogue that is mostly unsold. The written table has a measured size, by which
    Catalyst chooses: a small one is broadcast and the events stay where they are; a large one is joined by sort-merge.
    Finding the products costs one pass over a single column, combined map-side.
    """
    spark = events.sparkSession
    path = path or scratch_dir(spark, "catalogue")
    occurring = events.select(F.col("product_id").alias("occurring")).distinct()
    # Null-safe, so that no not-NULL filter is derived for the events: a product id taken from JSON would be parsed twice.
    used = catalogue.join(occurring, F.col("product_id").eqNullSafe(F.col("occurring")), "left_semi")
    used.write.mode("overwrite").parquet(path)
    return spark.read.schema(catalogue.schema).parquet(path)
