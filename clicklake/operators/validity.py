"""The category that a product had when the event happened: a lookup in a catalogue whose rows are valid for a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clicklake import schema as S
from clicklake.functions.time import MICROS, micros

_ALWAYS = -(1 << 62)  # before every time, also in cells


def _salt(split: Column | int, splits: int) -> Column:
    return F.pmod(split, F.lit(splits)).cast("int").alias("salt") if isinstance(split, Column) else F.lit(split).alias("salt")


def _versions(catalogue: DataFrame, cell_micros: int) -> DataFrame:
    """(product_id, cell, at, version), one version per product and start: of several the alphabetically first that is not empty."""
    at = F.coalesce(micros("valid_from"), F.lit(_ALWAYS)).alias("at")
    named = F.nullif(F.col("category"), F.lit("")).alias("category")
    version = F.struct(named.isNull().alias("unnamed"), named, micros("valid_to").alias("until"))
    first = catalogue.where(F.col("product_id").isNotNull()).groupBy("product_id", at).agg(F.min(version).alias("version"))
    return first.select("product_id", _cell(F.col("at"), cell_micros), "at", "version")


def _cell(at: Column, cell_micros: int) -> Column:
    return F.floor(at / F.lit(cell_micros)).cast("bigint").alias("cell")


def _carried(placed: DataFrame, versions: DataFrame) -> DataFrame:
    """The version that each (product, cell) with events starts with: the last one of the product's cells before it.

    Ordered per product are cells, not events: their number is the time range over the cell's width, whatever the product sells.
    """
    last = versions.groupBy("product_id", "cell").agg(F.max_by("version", "at").alias("version"), F.lit(1).alias("kind"))
    asked = placed.select("product_id", "cell").distinct().withColumn("version", F.lit(None).cast(last.schema["version"].dataType)).withColumn("kind", F.lit(0))
    before = Window.partitionBy("product_id").orderBy("cell", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = asked.unionByName(last).withColumn("version", F.last("version", ignorenulls=True).over(before))
    return both.where((F.col("kind") == 0) & F.col("version").isNotNull()).select("product_id", "cell", F.lit(_ALWAYS).alias("at"), "version")


def enrich_category_as_of(
    events: DataFrame,
    catalogue: DataFrame,
    fallback: str | None = S.FALLBACK_CATEGORY,
    time: str = "event_time",
    cell_seconds: int = 86_400,
    splits: int = 8,
) -> DataFrame:
    """Each event's category at its time, from catalogue rows (product_id, category, valid_from, valid_to).

    The row with the product's latest ``valid_from`` up to the event's time counts, unless it has ended: ``valid_to`` is not
    valid any more, NULL is open on either side. Else the event's own category counts, or ``fallback``; an empty category is none. Events
    without a time or a product find no row.

    No range join: catalogue rows and events are put in one order and each event takes the last row before it. The order is
    that of a product, a cell of time and a split of the events by their hash, so a product with a third of all events has cells x splits tasks;
    its catalogue rows of a cell, and the one that the cell starts with, go to each split. Copies of one event meet in one task, which spills.
    """
    width = cell_seconds * MICROS
    whole = events.select(F.struct("*").alias("row"))
    at, product = micros(F.col(f"row.`{time}`")), F.col("row.product_id")
    split = F.xxhash64("row")
    known = at.isNotNull() & product.isNotNull()
    # What cannot be looked up is dealt by its hash alone.
    placed = whole.select(
        product.alias("product_id"), F.when(known, _cell(at, width)).otherwise(split).alias("cell"), F.when(known, at).alias("at"),
        _salt(split, splits), "row", F.lit(1).alias("kind"),
    )
    versions = _versions(catalogue, width)
    listed = versions.unionByName(_carried(placed.where(F.col("at").isNotNull()), versions))
    copies = F.explode(F.sequence(F.lit(0), F.lit(splits - 1))).alias("salt")
    ordered = placed.unionByName(listed.select("product_id", "cell", "at", copies, "version", F.lit(0).alias("kind")), allowMissingColumns=True)
    so_far = Window.partitionBy("product_id", "cell", "salt").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = ordered.withColumn("version", F.last("version", ignorenulls=True).over(so_far)).where(F.col("kind") == 1)
    until = F.col("version.until")
    valid = F.when(F.col("at").isNotNull() & (until.isNull() | (F.col("at") < until)), F.col("version.category"))
    own = [F.nullif(F.col("row.category"), F.lit(""))] if "category" in events.columns else []
    last = [] if fallback is None else [F.lit(fallback)]
    category = F.coalesce(valid, *own, *last).alias("category")
    if "category" in events.columns:
        return found.select(*[category if c == "category" else F.col(f"row.`{c}`") for c in events.columns])
    return found.select("row.*", category)
