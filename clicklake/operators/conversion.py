"""Purchases per view by category, and the category lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clicklake import schema as S
from clicklake.functions.metrics import conversion_rate
from clicklake.operators.activity import activity, rolled_up
from clicklake.operators.products import ranked_within


def unique_products(catalogue: DataFrame) -> DataFrame:
    """(product_id, category), each product once: of several categories the alphabetically first one that is not empty."""
    named = F.nullif(F.col("category"), F.lit(""))
    return catalogue.groupBy("product_id").agg(F.min(named).alias("category"))


def enrich_category(rows: DataFrame, catalogue: DataFrame, fallback: str | None = S.FALLBACK_CATEGORY) -> DataFrame:
    """Each product's category; where the catalogue has none, the row's own if it carries one, else ``fallback``.

    ``rows`` may be events or counts per product. No side is marked for broadcast: Catalyst broadcasts the two catalogue
    columns while their size is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, where adaptive
    execution splits a hot product. An empty category is none.
    """
    listed = unique_products(catalogue).withColumnRenamed("category", "listed")
    own = [F.nullif(F.col("category"), F.lit(""))] if "category" in rows.columns else []
    last = [] if fallback is None else [F.lit(fallback)]
    choices = [F.col("listed"), *own, *last]
    return rows.join(listed, "product_id", "left").withColumn("category", F.coalesce(*choices)).drop("listed")


def with_conversion_rate(counts: DataFrame) -> DataFrame:
    return counts.withColumn("conversion_rate", conversion_rate())


def category_conversion(events: DataFrame, *keys: str) -> DataFrame:
    """Views, purchases and their ratio per category, for events that carry their category."""
    return with_conversion_rate(activity(events, *keys, "category"))


def catalogue_conversion(events: DataFrame, catalogue: DataFrame, *keys: str, fallback: str | None = S.FALLBACK_CATEGORY) -> DataFrame:
    """The same from a catalogue. Events are counted per product first: the join sees each product once, never an event."""
    per_product = activity(events, *keys, "product_id")
    return with_conversion_rate(rolled_up(enrich_category(per_product, catalogue, fallback), *keys, "category"))


def ordered_by_rate(conversion: DataFrame) -> DataFrame:
    """Best category first, ties by name; a distributed sort."""
    return conversion.orderBy(F.desc("conversion_rate"), F.asc("category"))


def ranked_by_rate(conversion: DataFrame, day: str = "event_date") -> DataFrame:
    """The same order as a rank within each day."""
    return ranked_within(conversion, day, order=[F.desc("conversion_rate"), F.asc("category")])
