"""Merkle manifest of a dataset, kept as a persistent tree: a changed leaf makes a version that shares all nodes it does not touch.

Leaves are rows' digests, in order within a group (a source). Every ``ARITY`` consecutive nodes have a parent, up to the group's one
subroot; the subroots, in order of their groups, have a tree of the same kind above them, whose root stands for the dataset.

The tree is stored in aligned blocks: a block holds the nodes over ``ARITY ** BLOCK_LEVELS`` consecutive ones, and is built in one piece. Blocks of blocks follow until every group has one node. A level of blocks is a table, so a group of any size is spread
over as many tasks as it has blocks.

Versions are made by path copying. In its block a changed leaf copies its own ancestors, nothing else; above, the version goes on with the
path that its block has through the upper blocks, which comes down to each block as its siblings by level, in a join of blocks, so that
upper versions are continued where their leaves are.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from clicklake.llm.common import written

ARITY = 16
BLOCK_LEVELS = 3  # 4,096 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_HEX = 64  # length of a digest as text
_PATH = "array<struct<left:string,right:string>>"


def encoded(value: Column) -> Column:
    """``-`` for null, else length in bytes, a colon and the value as text: no two rows of values have the same text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(encoded, values)), 256))


class BlockTree:
    """The nodes over a block's members (digests of 32 bytes), as one hex text for each level.

    A block that is all of its group (of ``total`` nodes) ends at its one node, others have all ``height`` levels above the members.
    """

    def __init__(self, members: list[bytes], total: int, height: int) -> None:
        self.levels = [b"".join(members).hex().encode()]
        alone = total <= ARITY**height
        while len(self.levels[-1]) > _HEX if alone else len(self.levels) <= height:
            nodes, run = self.levels[-1], ARITY * _HEX
            self.levels.append("".join(sha256(nodes[i : i + run]).hexdigest() for i in range(0, len(nodes), run)).encode())

    @property
    def root(self) -> bytes:
        return bytes.fromhex(self.levels[-1].decode())

    def siblings(self, at: int) -> list[tuple[bytes, bytes]]:
        """What stands left and right of the member and of each of its ancestors in their runs, up to the block's root."""
        out = []
        for nodes in self.levels[:-1]:
            first = at // ARITY * ARITY * _HEX
            out.append((nodes[first : at * _HEX], nodes[(at + 1) * _HEX : first + ARITY * _HEX]))
            at //= ARITY
        return out


def copied_path(leaf: bytes, siblings: list[tuple[bytes, bytes]]) -> list[bytes]:
    """The nodes of the version that has ``leaf`` (hex) instead of a member: the leaf and its new ancestors, the last being the root."""
    out = [leaf]
    for left, right in siblings:
        out.append(sha256(left + out[-1] + right).hexdigest().encode())
    return out


def _indexed(nodes: DataFrame, key: str, *order: str) -> DataFrame:
    """``nodes`` with ``index``, the place in its group (0 first, null keys and values first), and ``total``, the group's size.

    Rows are split by ranges of the whole order, so a group of any size is ordered in many tasks; a row per group and range is then
    counted up.
    """
    by = [key, *order]
    placed = written(nodes.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("_at", 33)
    runs = placed.groupBy(F.col(key).alias("_key"), part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    group = Window.partitionBy("_key")
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_key", "_part", F.sum("_rows").over(group).alias("total"), (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    joined = placed.join(runs, F.col(key).eqNullSafe(F.col("_key")) & (part == F.col("_part")))
    return joined.withColumn("index", F.col("_at") + F.col("_shift")).drop("_at", "_key", "_part", "_shift")


def _block_root(members: str, total: str, height: int) -> Column:
    @F.pandas_udf("binary")
    def root(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for lists, totals in batches:
            yield pd.Series([BlockTree(list(m), t, height).root for m, t in zip(lists, totals, strict=True)], dtype=object)

    return root(members, total)


def _grown(nodes: DataFrame, key: str, height: int, *more: str) -> tuple[list[DataFrame], DataFrame]:
    """Tables of blocks from the bottom up (key, block, total, digest and ``more`` as arrays by place, root), and (key, digest) of each
    group's one node. ``nodes``: key, index, total, digest and ``more``."""
    tables, ends = [], []
    while True:
        names = ["digest", *(more if not tables else ())]
        members = F.sort_array(F.collect_list(F.struct("index", *names)))
        block = F.floor(F.col("index") / F.lit(ARITY**height)).alias("block")
        blocks = nodes.groupBy(key, block, "total").agg(members.alias("m"))
        blocks = blocks.select(key, "block", "total", *[F.col("m")[n].alias(n) for n in names])
        blocks = written(blocks.withColumn("root", _block_root("digest", "total", height)), "merkle-blocks")
        tables.append(blocks)
        above = F.ceil(F.col("total") / F.lit(ARITY**height)).alias("total")
        nodes = blocks.select(key, F.col("block").alias("index"), above, F.col("root").alias("digest"))
        ends.append(nodes.where("total = 1").select(key, "digest"))
        nodes = nodes.where("total > 1")
        if nodes.isEmpty():
            break
    roots = ends[0]
    for more_roots in ends[1:]:
        roots = roots.unionByName(more_roots)
    return tables, roots


def _with_above(blocks: DataFrame, above: DataFrame | None, key: str) -> DataFrame:
    """The blocks with the siblings that they have in the blocks above them, by level."""
    if above is None:
        return blocks.withColumn("above", F.array().cast(_PATH))
    named = above.select(F.col(key).alias("_key"), F.col("index").alias("_index"), "above")
    joined = blocks.join(named, F.col(key).eqNullSafe(F.col("_key")) & (F.col("block") == F.col("_index")), "left")
    return joined.drop("_key", "_index").withColumn("above", F.coalesce("above", F.array().cast(_PATH)))


def _descended(blocks: DataFrame, above: DataFrame | None, key: str, height: int, *more: str) -> DataFrame:
    """(key, index, above and ``more``) of every member of the blocks: its siblings in the block and above, by level."""
    rows = _with_above(blocks, above, key).select(key, "block", "total", "digest", "above", *more)
    schema = [rows.schema[key], *[f for f in rows.schema if f.name in more]]
    types = ", ".join(f"`{f.name}` {(f.dataType if f.name == key else f.dataType.elementType).simpleString()}" for f in schema)

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1)
                block, total, digests, higher = (row.column(c)[0].as_py() for c in ("block", "total", "digest", "above"))
                tree = BlockTree(digests, total, height)
                paths = [[{"left": a.decode(), "right": b.decode()} for a, b in tree.siblings(i)] + higher for i in range(len(digests))]
                out = {key: pa.array([row.column(key)[0].as_py()] * len(digests), row.column(key).type)}
                out |= {name: row.column(name).flatten() for name in more}
                out["index"] = pa.array([block * ARITY**height + i for i in range(len(digests))], pa.int64())
                out["above"] = pa.array(paths, pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))
                yield pa.RecordBatch.from_pydict(out)

    return written(rows.mapInArrow(members, f"{types}, index bigint, above {_PATH}"), "merkle-paths")


def _path_above(tables: list[DataFrame], key: str, height: int) -> DataFrame | None:
    """The paths of the lowest blocks, brought down from the top; none if no group has two blocks."""
    above = None
    for blocks in reversed(tables[1:]):
        above = _descended(blocks, above, key, height)
    return above


def manifest(docs: DataFrame, changed: Column | None = None, text: Column | None = None, keep_versions: bool = False, height: int = BLOCK_LEVELS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, lang, n_chars, text; other columns are not used): doc_id, leaf, subroot, root,
    proof_sha256 (of all siblings, level by level, left to right), folded_root, verified and, if asked, version.

    Where ``changed`` holds, the row makes a version whose leaf has ``text`` instead of its own; ``folded_root`` is that version's root,
    and ``version`` its copied nodes from the leaf up. Elsewhere folded_root is computed from the row's own leaf, and there is no version.

    Null values have an encoding of their own; a null source is a group, the first; rows without an id come first in their group;
    empty and very long texts are texts; repeated rows are leaves each, next to each other, in the order of their digests; a null
    ``changed`` changes nothing; an empty table gives no rows.
    """
    own = [F.col(name) for name in FIELDS]
    replaced = [text if name == "text" and text is not None else F.col(name) for name in FIELDS]
    other = F.when(changed, row_digest(*replaced)) if changed is not None else F.lit(None).cast("binary")
    leaves = written(docs.select("doc_id", "source", row_digest(*own).alias("digest"), other.alias("other")), "merkle-leaves")
    tables, subroots = _grown(_indexed(leaves, "source", "doc_id", "digest", "other"), "source", height, "doc_id", "other")
    top, roots = _grown(_indexed(written(subroots, "merkle-subroots").withColumn("_all", F.lit(0)), "_all", "source"), "_all", height, "source")
    found = roots.first()
    root = found["digest"].hex() if found else ""
    groups = _descended(top[0].withColumn("subroot", F.col("digest")), _path_above(top, "_all", height), "_all", height, "source", "subroot")
    groups = groups.select(F.col("source").alias("_group"), "subroot", F.col("above").alias("top"))
    rows = _with_above(tables[0], _path_above(tables, "source", height), "source").drop("root")
    rows = rows.join(groups, F.col("source").eqNullSafe(F.col("_group")))
    rows = rows.select("total", "doc_id", "digest", "other", "subroot", F.concat("above", "top").alias("above"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1)
                digests, others, above = (row.column(c)[0].as_py() for c in ("digest", "other", "above"))
                tree = BlockTree(digests, row.column("total")[0].as_py(), height)
                higher = [(level["left"].encode(), level["right"].encode()) for level in above]
                proofs, folded, versions = [], [], []
                for at, (digest, new) in enumerate(zip(digests, others, strict=True)):
                    siblings = tree.siblings(at) + higher
                    proofs.append(sha256(b"".join(part for level in siblings for part in level)).hexdigest())
                    version = copied_path((digest if new is None else new).hex().encode(), siblings)
                    folded.append(version[-1].decode())
                    versions.append(None if new is None else [node.decode() for node in version])
                size, subroot = len(digests), row.column("subroot")[0].as_py().hex()
                out = {
                    "doc_id": row.column("doc_id").flatten(),
                    "leaf": pa.array([d.hex() for d in digests]),
                    "subroot": pa.array([subroot] * size),
                    "root": pa.array([root] * size),
                    "proof_sha256": pa.array(proofs),
                    "folded_root": pa.array(folded),
                    "verified": pa.array([f == root for f in folded]),
                }
                if keep_versions:
                    out["version"] = pa.array(versions, pa.list_(pa.string()))
                yield pa.RecordBatch.from_pydict(out)

    return rows.mapInArrow(verify, schema + (", version array<string>" if keep_versions else ""))


def nodes(tables: list[DataFrame], key: str, height: int = BLOCK_LEVELS) -> DataFrame:
    """(key, height, index, digest) of every node of a group tree: the nodes that all versions share with it where they copied none."""
    out = []
    for k, blocks in enumerate(tables):

        def listed(batches: Iterator[pa.RecordBatch], k: int = k) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for n in range(batch.num_rows):
                    row = batch.slice(n, 1)
                    block, total, digests = (row.column(c)[0].as_py() for c in ("block", "total", "digest"))
                    levels = BlockTree(digests, total, height).levels
                    if total > ARITY**height:
                        levels.pop()  # the block's root is a member of the block above it
                    for up, level in enumerate(levels):
                        count = len(level) // _HEX
                        yield pa.RecordBatch.from_pydict(
                            {
                                key: pa.array([row.column(key)[0].as_py()] * count, row.column(key).type),
                                "height": pa.array([k * height + up] * count, pa.int32()),
                                "index": pa.array([block * ARITY ** (height - up) + i for i in range(count)], pa.int64()),
                                "digest": pa.array([level[i * _HEX : (i + 1) * _HEX].decode() for i in range(count)]),
                            }
                        )

        kind = blocks.schema[key].dataType.simpleString()
        out.append(blocks.select(key, "block", "total", "digest").mapInArrow(listed, f"`{key}` {kind}, height int, index bigint, digest string"))
    every = out[0]
    for table in out[1:]:
        every = every.unionByName(table)
    return every


def build(docs: DataFrame, height: int = BLOCK_LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """The groups' trees over ``docs``: their tables of blocks, and (source, digest) of the subroots."""
    leaves = written(docs.select("doc_id", "source", row_digest(*[F.col(name) for name in FIELDS]).alias("digest")), "merkle-leaves")
    return _grown(_indexed(leaves, "source", "doc_id", "digest"), "source", height)
