"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clicklake.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long): root is the smallest node of its component.

    Alternating large-star and small-star steps (Kiveris et al. 2014). A node's smallest neighbour is an aggregate combined before
    its shuffle, and the join that spreads it can be split, so a node with very many neighbours needs no large task. Each
    step is written to the shared folder; the driver sees a count and a checksum. Loops are ignored; no edges: no rows.
    """
    current = written(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-edges"
    )
    state = _state(current)
    while state[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = large.join(least, "u").select(F.explode(ends).alias("e")).select("e.*").where("u != v").distinct()
        current = written(small, f"{name}-edges")
        before, state = state, _state(current)
        if state == before:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
