"""Near-duplicate vectors by NN-descent.

1. Equal vectors of a label are one node with a count.
2. First lists: random hyperplanes give each node a signature in each of several tables; nodes sorted by signature are compared with those
   next to them, and a list keeps the ``LIST`` best, whatever their cosine. Sorting splits any crowd, so no bucket is a task.
3. Descent: the neighbours of a node are compared with each other, pairs better than a list's last are kept, and lists are refined, until
   a round brings no link. A list that is full of links is saturated and is given twice the length for the next round, up to ``LONGEST``.
4. Links are pairs of at least the threshold, and make components. Lists still saturated are made whole exactly: the members of a
   component are compared with all of its members, block by block, and counted, without giving out the pairs.
5. Audit: some nodes are compared with all vectors of their label, those of large components and the others each for themselves, until
   ``WITNESSES`` of them have links. A node's recall is the share of its links that were found. If the mean is less than ``RECALL`` for
   either kind, or too few nodes with links were seen, more tables are added.

The first number of tables is such that a pair at the threshold meets in one of them with probability ``RECALL``, in a label of evenly
spread vectors: the larger the label, the more bits two signatures must share to be neighbours.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from clicklake.llm.common import unit, written
from clicklake.llm.graph import connected_components
from clicklake.llm.vectors import matrix, usable

THRESHOLD = 0.93
TABLES = 8
BITS = 32
LIST = 16
LONGEST = 64
NEXT = 32
BLOCK = 512
AUDITED = 256
MOST_AUDITED = 4096
WITNESSES = 100
RECALL = 0.99
MOST_TABLES = 32

_EDGE = "a long, b long, sim double"


def directions(rows: DataFrame) -> DataFrame:
    """(vec_id, grp, v) of every row: v the vector at length 1, grp its label and number of components; null where it links with nothing."""
    vector = F.when(usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.transform("embedding", lambda x: x.cast("double")))
    found = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), vector.alias("v"))
    found = found.withColumn("most", F.array_max(F.transform("v", F.abs)))
    found = found.withColumn("v", F.when(F.col("most") > 0, F.transform("v", lambda x: x / F.col("most"))))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    found = found.select("vec_id", "label", "v", norm.alias("norm"))
    grp = F.when(F.col("v").isNotNull(), F.concat_ws(":", F.size("v").cast("string"), "label"))
    return found.select("vec_id", grp.alias("grp"), F.transform("v", lambda x: x / F.col("norm")).alias("v"))


def nodes_of(directed: DataFrame) -> DataFrame:
    """(grp, v, node, n): the distinct vectors that can link, with their smallest id and their count."""
    return directed.where("grp is not null").groupBy("grp", "v").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("n"))


def _signatures(nodes: DataFrame, tables: range) -> DataFrame:
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, some in batch.groupby(batch["v"].map(len)):
                x = matrix(some["v"])
                for table in tables:
                    planes = np.random.default_rng(1000 + table).standard_normal((x.shape[1], BITS))
                    code = ((x @ planes) > 0) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                    out = some[["grp", "node"]].copy()
                    out["place"], out["code"] = table, code
                    out["v"] = list(x.astype(np.float32))
                    yield out

    return nodes.select("grp", "node", "v").mapInPandas(sign, "grp string, node long, place int, code long, v array<float>")


def first_edges(nodes: DataFrame, tables: range) -> DataFrame:
    """Pairs of neighbours in the order of the signatures: for each node its best in each table."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail = None
        for batch in batches:
            batch = batch if tail is None else pd.concat([tail, batch], ignore_index=True)
            parts = []
            for _, some in batch.groupby(["grp", "place"], sort=False):
                x, ids = matrix(some["v"], np.float64), some["node"].to_numpy()
                for i in range(0, len(ids), NEXT):
                    near = x[i : i + 2 * NEXT]
                    sim = near[:NEXT] @ near.T
                    rank = np.argsort(-sim, axis=1, kind="stable")[:, : LIST + 1]
                    row = np.repeat(np.arange(len(sim)), rank.shape[1])
                    col = rank.ravel()
                    keep = row != col
                    parts.append((ids[i + row[keep]], ids[i + col[keep]], sim[row[keep], col[keep]]))
            tail = batch.iloc[-2 * NEXT :]  # meets the next batch again
            a, b, sim = (np.concatenate([p[k] for p in parts]) for k in range(3))
            yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "sim": sim})

    signed = _signatures(nodes, tables)
    ordered = signed.repartitionByRange("grp", "place", "code", "node").sortWithinPartitions("grp", "place", "code", "node")
    return ordered.mapInPandas(compare, _EDGE).where("a != b")


def _cosines(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b, sim) of pairs of nodes of one group, in double precision."""
    a, b = nodes.select(F.col("node").alias("a"), F.col("grp").alias("ga"), F.col("v").alias("va")), nodes.select(F.col("node").alias("b"), F.col("grp").alias("gb"), F.col("v").alias("vb"))
    joined = pairs.join(a, "a").join(b, "b").where("ga = gb")
    dot = F.aggregate(F.zip_with("va", "vb", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return joined.select("a", "b", dot.alias("sim"))


def _lists(edges: DataFrame, length: int, threshold: float) -> DataFrame:
    """(node, other, sim, rank): each node's best neighbours. Lists of ``LIST``, and of ``length`` where that many would be links."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other"), "sim").unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other"), "sim"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("sim"), "other"))
    ranked = both.withColumn("rank", rank).where(F.col("rank") <= length)
    return ranked.where((F.col("rank") <= LIST) | (F.col("sim") >= threshold))


def _trimmed(edges: DataFrame, threshold: float) -> DataFrame:
    """The edges in the list of one of their ends, and the links: what is near the threshold is kept, to be computed again."""
    listed = _lists(edges, LIST, threshold).select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"), "sim")
    return listed.unionByName(edges.where(F.col("sim") >= threshold - 1e-4)).groupBy("a", "b").agg(F.max("sim").alias("sim"))


def _met(lists: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(a, b, sim) of neighbours of one node that are links, or better than the last of a list of theirs."""
    last = lists.groupBy("node").agg(F.when(F.count(F.lit(1)) >= LIST, F.min(F.when(F.col("rank") <= LIST, F.col("sim")))).alias("last"))
    ends = nodes.select("node", "v").join(last, "node").select(F.col("node").alias("other"), "v", F.coalesce("last", F.lit(-2.0)).alias("last"))

    def pairs(rows: pd.DataFrame) -> pd.DataFrame:
        x, ids, least = matrix(rows["v"]), rows["other"].to_numpy(), rows["last"].to_numpy()
        sim = x @ x.T
        keep = (ids[:, None] < ids[None, :]) & ((sim > np.minimum(least[:, None], least[None, :])) | (sim >= threshold))
        row, col = np.nonzero(keep)
        return pd.DataFrame({"a": ids[row], "b": ids[col], "sim": sim[row, col]})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail = None
        for batch in batches:
            batch = batch if tail is None else pd.concat([tail, batch], ignore_index=True)
            open_ = batch["node"] == batch["node"].iloc[-1]  # its list may go on in the next batch
            tail, whole = batch[open_], batch[~open_]
            if len(whole):
                yield pd.concat([pairs(rows) for _, rows in whole.groupby("node", sort=False)])
        if tail is not None:
            yield pairs(tail)

    dealt = lists.select("node", "other").join(ends, "other").repartition("node").sortWithinPartitions("node")
    return dealt.mapInPandas(compare, _EDGE).groupBy("a", "b").agg(F.max("sim").alias("sim"))


def descend(edges: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Refined edges: neighbours of neighbours compared, until a round finds no new link."""
    length = LIST
    while True:
        lists = written(_lists(edges, length, threshold), "nn-lists")
        new = written(_met(lists, nodes, threshold).join(edges.select("a", "b"), ["a", "b"], "left_anti"), "nn-new")
        if new.where(F.col("sim") >= threshold).isEmpty():
            return edges
        edges = written(_trimmed(edges.unionByName(new), threshold), "nn-edges")
        length = min(LONGEST, 2 * length)


def _blocks(members: DataFrame, threshold: float) -> DataFrame:
    """(node, links) of ``members`` (component, size, node, n, v): links within the component, counted with the copies."""
    count = F.ceil(F.col("size") / BLOCK).cast("long")
    own = F.pmod(F.xxhash64("node"), count)
    spread = members.withColumn("count", count).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)))
    spread = spread.select("component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "n", "v")
    key = ["component", "i", "j"]

    def links(held: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(held)
        x, n, own = matrix(rows["v"]), rows["n"].to_numpy(), rows["own"].to_numpy()
        ids, cross = rows["node"].to_numpy(), rows["i"].iloc[0] != rows["j"].iloc[0]
        linked = x @ x.T >= threshold
        np.fill_diagonal(linked, False)
        if cross:
            linked &= own[:, None] != own[None, :]
        return pd.DataFrame({"node": ids, "links": (linked * n[None, :]).sum(1)})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, now = [], None
        for batch in batches:
            out = []
            for at, some in batch.groupby(key, sort=False):
                if at != now and held:
                    out.append(links(held))
                    held = []
                now = at
                held.append(some)
            if out:
                yield pd.concat(out)
        if held:
            yield links(held)

    dealt = spread.repartition(*key).sortWithinPartitions(*key, "node")
    return dealt.mapInPandas(compare, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def tables_for(size: int, threshold: float) -> int:
    """Tables in which a pair at the threshold, in a label of ``size`` evenly spread vectors, meets with probability ``RECALL``."""
    same = 1 - math.acos(threshold) / math.pi
    meets = same ** min(BITS, max(0.0, math.log2(max(1, size) / NEXT)))
    return TABLES if meets > 1 - 1e-9 else max(TABLES, math.ceil(math.log(1 - RECALL) / math.log(1 - meets)))


def _recalls(chosen: list, nodes: DataFrame, counts: DataFrame, threshold: float) -> list[float]:
    """The share of its links that ``counts`` has, for each of the chosen nodes that has links."""
    groups: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for grp in {r["grp"] for r in chosen}:
        own = [r for r in chosen if r["grp"] == grp]
        groups[grp] = np.array([r["node"] for r in own]), np.array([r["v"] for r in own])

    def brute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {grp: np.zeros(len(ids), np.int64) for grp, (ids, _) in groups.items()}
        for batch in batches:
            for grp, some in batch.groupby("grp"):
                if grp in groups:
                    ids, x = groups[grp]
                    others, n = some["node"].to_numpy(), some["n"].to_numpy()
                    y = matrix(some["v"])
                    for i in range(0, len(ids), BLOCK):
                        linked = (x[i : i + BLOCK] @ y.T >= threshold) & (ids[i : i + BLOCK, None] != others[None, :])
                        sums[grp][i : i + BLOCK] += (linked * n[None, :]).sum(1)
        for grp, (ids, _) in groups.items():
            yield pd.DataFrame({"node": ids, "links": sums[grp]})

    true = nodes.mapInPandas(brute, "node long, links long").groupBy("node").agg(F.sum("links").alias("all_links")).where("all_links > 0")
    both = true.join(counts, "node", "left").select("all_links", F.coalesce("links", F.lit(0)).alias("links")).collect()
    return [min(1.0, r["links"] / r["all_links"]) for r in both]


def _audit(nodes: DataFrame, sizes: DataFrame, counts: DataFrame, threshold: float) -> tuple[float | None, bool]:
    """The mean share of a node's links that ``counts`` (node, links) has, of the kind of nodes that has less; and whether enough was seen.

    ``sizes`` (node, size) has the components found. Nodes of components larger than ``LONGEST`` are one kind, all others the other, so
    that a crowd does not hide lost pairs. Nodes are drawn until ``WITNESSES`` have links, all are drawn (what is then seen is the whole
    truth) or ``MOST_AUDITED`` are. None: no node with links was seen among those drawn, and others are left.
    """
    crowd, u = F.coalesce("size", F.lit(1)) > LONGEST, unit(F.col("node"), F.lit("audit"))
    sized = written(nodes.join(sizes, "node", "left").select("grp", "node", "v", crowd.alias("crowd"), u.alias("u")), "nn-audit")
    found, enough = [], True
    for kind, total in sized.groupBy("crowd").count().collect():
        low, high, shares = 0.0, min(1.0, AUDITED / total), []
        while True:
            chosen = sized.where((F.col("crowd") == kind) & (F.col("u") >= low) & (F.col("u") < high)).select("node", "grp", "v").collect()
            shares += _recalls(chosen, nodes, counts, threshold)
            if len(shares) >= WITNESSES or high >= 1.0:
                break
            if high >= MOST_AUDITED / total:
                enough = False
                break
            low, high = high, min(1.0, MOST_AUDITED / total, 4 * high)
        if shares or high >= 1.0:
            found.append(sum(shares) / len(shares) if shares else 1.0)
    return (min(found) if found else 1.0 if enough else None), enough


def near_duplicate_vectors(rows: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, float | None]:
    """(vec_id, n_links, component_id, kept) for every row of ``rows`` (vec_id, embedding, label), and the recall that the audit measured.

    A recall below ``RECALL`` with the last table is an error. Where even then too few of the audited nodes have links to measure it, a
    warning says so, and without any the recall is None.

    A null label, and a vector that is null, empty, all zero or holds null or non-finite components, links with nothing: no links, its own
    component. Vectors of different length do not link. Repeated rows are vectors that link with each other. A null id has a null component
    and is not kept. Other columns are not used; an empty table gives no rows.
    """
    directed = written(directions(rows), "nn-directions")
    nodes = written(nodes_of(directed), "nn-nodes")
    largest = nodes.groupBy("grp").count().agg(F.max("count")).first()[0] or 0
    edges, done, goal = None, 0, tables_for(largest, threshold)
    most = max(MOST_TABLES, 2 * goal)
    while True:
        fresh = first_edges(nodes, range(done, goal))
        done, goal = goal, goal + TABLES
        every = fresh if edges is None else fresh.unionByName(edges)
        edges = written(_trimmed(every.groupBy("a", "b").agg(F.max("sim").alias("sim")), threshold), "nn-first")
        edges = descend(edges, nodes, threshold)
        # The sums of the first search are in single precision: what is near the threshold is computed again.
        sure = _cosines(edges.where(F.col("sim") >= threshold - 1e-4).select("a", "b"), nodes).where(F.col("sim") >= threshold)
        components = written(connected_components(sure.select("a", "b"), "nn"), "nn-components")
        sizes = components.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
        members = components.join(sizes, "root").join(nodes, "node").select(F.col("root").alias("component"), "size", "node", "n", "v")
        counts = written(_blocks(members, threshold), "nn-counts")
        recall, enough = _audit(nodes, members.select("node", "size"), counts, threshold)
        if enough and recall >= RECALL:
            break
        if done >= most:
            if recall is not None and recall < RECALL:
                raise RuntimeError(f"near_duplicate_vectors: {done} tables found {recall:.4f} of the audited nodes' links, less than {RECALL}")
            warnings.warn(f"near_duplicate_vectors: too few of the audited nodes have links to measure the recall of {done} tables", stacklevel=2)
            break
    found = nodes.join(components, "node", "left").join(counts, "node", "left")
    found = found.select("grp", "v", F.coalesce("root", "node").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"))
    out = directed.join(found, ["grp", "v"], "left")
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))), recall
