"""Near-duplicate documents by SimHash, candidates filtered by the pigeonring principle.

A fingerprint of 64 bits is cut into max_distance + 1 consecutive segments, seen as a ring. Two fingerprints within the distance
have a segment from which every chain of l consecutive segments differs in at most floor(l * d / (d + 1)) = l - 1 bits: the
first not at all, the first two in one bit at most, and so on. The join key holds the first segment and one half of the second (one
differing bit leaves a half as it is); longer chains and the whole distance are checked on the pairs of a key.

Keys shared by more than ``BUCKET`` distinct fingerprints make no pairs: their members meet at the fingerprints one bit away from
them, as two fingerprints differ in at most 2 bits if and only if they have such a neighbour (or each other) in common. So a
fingerprint makes 65 rows there, whatever the size of the group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from clicklake.llm.common import byte_words, release, written
from clicklake.llm.graph import connected_components

SHINGLE = 3
MAX_DISTANCE = 2
SEED = 42
BITS = 64
BUCKET = 64


def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of one text as a signed 64-bit number; 0 without words."""
    if text is None:
        return 0
    ones, total, carry = np.zeros(BITS, np.int64), 0, []
    for words in byte_words(text.encode("utf-8", "surrogatepass").lower()):  # bytes.lower() changes A-Z alone
        words = carry + words
        if len(words) < shingle:
            carry = words
            continue
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], np.uint64)
        ones += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(hashes)
        carry = words[len(words) - shingle + 1 :]
    if not total:
        return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(carry), SEED)).astype(np.int64)) if carry else 0
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        release()
        for texts in batches:
            yield pd.Series([text_fingerprint(t, shingle) for t in texts], dtype="int64")

    return of(text)


def _segments(max_distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment."""
    m = max_distance + 1
    ends = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:], strict=False)]


def _bits(fp: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))


def _keys(fp: Column, max_distance: int) -> Column:
    """Two keys for each segment that a chain may start from: the segment with either half of the next one."""
    segments, keys = _segments(max_distance), []
    for i, (first, width) in enumerate(segments):
        after, span = segments[(i + 1) % len(segments)]
        half = span // 2
        for k, (a, w) in enumerate(((after, half), (after + half, span - half))):
            slot = (2 * i + k) << 56
            keys.append(F.shiftleft(_bits(fp, first, width), w).bitwiseOR(_bits(fp, a, w)).bitwiseOR(F.lit(slot).cast("long")))
    return F.array(*keys)


def _chain(a: Column, b: Column, max_distance: int) -> Column:
    """Whether some segment starts chains that all stay within their budgets, the longest being the whole ring."""
    segments, starts = _segments(max_distance), []
    differ = [F.bit_count(_bits(a.bitwiseXOR(b), first, width)) for first, width in segments]
    for i in range(len(segments)):
        total, fits = F.lit(0), F.lit(True)
        for length in range(1, len(segments) + 1):
            total = total + differ[(i + length - 1) % len(segments)]
            fits = fits & (total <= length * max_distance // len(segments))
        starts.append(fits)
    out = starts[0]
    for fits in starts[1:]:
        out = out | fits
    return out


def linked_fingerprints(prints: DataFrame, max_distance: int = MAX_DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) that join the fingerprints of ``prints`` (fp long, distinct) as links of at most ``max_distance`` bits do.

    Pairs of crowded keys are given as a star around a common neighbour, which has the same components.
    """
    if max_distance not in (1, 2):
        raise ValueError("max_distance is 1 or 2")
    keys = prints.select("fp", F.explode(_keys(F.col("fp"), max_distance)).alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keys = written(keys.join(shared, "key"), "simhash-keys")
    cool = keys.where(F.col("n") <= bucket)
    left, right = cool.select("key", F.col("fp").alias("a")), cool.select("key", F.col("fp").alias("b"))
    a, b = F.col("a"), F.col("b")
    pairs = (
        left.join(right, "key")
        .where(a < b)
        .where(_chain(a, b, max_distance))
        .where(F.bit_count(a.bitwiseXOR(b)) <= max_distance)
        .select("a", "b")
    )
    hot = keys.where(F.col("n") > bucket).select("fp").distinct()
    flips = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    near = hot.select("fp", F.explode(F.concat(F.array("fp"), flips)).alias("neighbour"))
    met = near.groupBy("neighbour").agg(F.collect_list("fp").alias("members")).where("size(members) > 1")  # 65 at most
    if max_distance == 1:  # two members can be 2 bits apart: the neighbour itself must be one of them
        met = met.where("array_contains(members, neighbour)").withColumn("a", F.col("neighbour"))
    else:
        met = met.withColumn("a", F.array_min("members"))
    star = met.select("a", F.explode("members").alias("b")).where("a != b")
    return pairs.unionByName(star).distinct()


def _grouped(prints: DataFrame, max_distance: int, bucket: int) -> DataFrame:
    """(fp, root, component_id) for every fingerprint of ``prints`` (doc_id, fp): root is one fingerprint of its group."""
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    linked = connected_components(linked_fingerprints(nodes.select("fp"), max_distance, bucket), "simhash")
    linked = linked.join(nodes, linked.node == nodes.fp).select("fp", "root", "first_id")
    roots = linked.groupBy("root").agg(F.min("first_id").alias("group_id"))
    grouped = linked.join(roots, "root").select("fp", "root", "group_id")
    return nodes.join(grouped, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("group_id", "first_id").alias("component_id"))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE, bucket: int = BUCKET
) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text; other columns are not used).

    Null and empty texts have fingerprint 0 and link like any other; repeated rows are rows of one group; a group whose ids
    are all null has a null component; an empty table gives no rows. Equal fingerprints are one node, so thousands of copies cost
    one; ids are reduced to their minimum before any shuffle.
    """
    prints = written(docs.select("doc_id", fingerprint(F.col("text"), shingle).alias("fp")), "simhash-prints")
    return prints.join(_grouped(prints, max_distance, bucket), "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row, all columns, of each group of ``docs``: the one with the smallest doc_id (null last), then fingerprint, then key.

    Rows are told apart by a key of id and text, so an id that is repeated with other texts, or no id at all, neither loses a
    document nor saves a copy; of rows repeated with both, one stays. A group whose ids are all null keeps one row like any other; an
    empty table gives no rows.
    """
    key = F.md5(F.concat_ws(":", F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("-")), F.md5(F.col("text"))))
    prints = docs.select("doc_id", fingerprint(F.col("text"), shingle).alias("fp"), key.alias("row_key"))
    prints = written(prints, "simhash-prints")
    best = F.min(F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "fp", "row_key"))
    first = prints.join(_grouped(prints, max_distance, BUCKET), "fp").groupBy("root").agg(best.alias("first"))
    found = prints.join(first.select(F.col("first.row_key").alias("row_key")), "row_key").groupBy("row_key").agg(F.count(F.lit(1)).alias("n"))
    found = written(found.withColumnRenamed("row_key", "kept_key"), "simhash-kept")
    kept = docs.join(found.select("kept_key"), key == F.col("kept_key"), "left_semi")
    if found.where("n > 1").isEmpty():
        return kept
    return kept.dropDuplicates(["doc_id", "text"])
