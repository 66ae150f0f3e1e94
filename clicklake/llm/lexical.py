"""Ranked lexical search for many items at once, by evaluating what their queries have in common once.

An item is a bag of terms; a document's score is the sum of what each of them is worth in it. In a block of items

1. terms that the same items hold the same number of times make one class: its sum is a partial accumulator that all of them share;
2. shared sets of classes are mined: each item's classes are listed, the most shared first, and the adjacent pairs that most items
   hold become nodes of their own, again and again, until no pair is left that two items hold;
3. so the items, the mined sets and the classes form a DAG, and each node of it is the sum of two others.

Documents are read once into counts of the items' terms. For a run of documents, the classes' accumulators are filled from these, every
mined set is materialised once from the two below it, level by level, and each item is the sum of the few nodes left in its list.
Each task keeps the best of its runs; only those meet in a shuffle.

Blocks of items bound what a task holds: a plan for about ``ITEMS`` items or ``ITEM_BYTES`` of their texts is mined in one task and sent to
all. Every block reads the documents again; the rows of a result do not depend on the blocks.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from clicklake.llm.common import byte_words, slices, written

ITEMS = 4096
ITEM_BYTES = 8 << 20
RUN_BYTES = 32 << 20  # of accumulators in a task
RUN_DOCS = 4096
SLICE_BYTES = 4 << 20
# Bytes of words, A-Z lowered; all other ASCII is space. Letters beyond ASCII are bytes from 0x80 on in UTF-8.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

Atom = tuple[bytes, int]


def term_counts(text: bytes | None) -> Counter[bytes]:
    """How often each term stands in a text."""
    counts: Counter[bytes] = Counter()
    for words in byte_words((text or b"").translate(_WORDS)):
        counts.update(words)
    return counts


@dataclass
class Plan:
    """The DAG of a block of items. Nodes are numbered classes first, then mined sets, those of a level after those below it."""

    items: list  # their ids
    terms: list[bytes]
    classes: list[list[tuple[int, int]]]  # of each term: (class, times)
    n_classes: int
    levels: list[tuple[list[int], list[int]]]  # of each level: the two nodes that each of its nodes is the sum of
    lists: list[list[int]]  # of each item: the nodes that it is the sum of

    @property
    def n_nodes(self) -> int:
        return self.n_classes + sum(len(left) for left, _ in self.levels)


def _pairs_to_join(lists: list[list[int]]) -> dict[tuple[int, int], int]:
    """Adjacent pairs to be nodes, with the number of items that would use them: at least two."""
    counts = Counter(pair for nodes in lists for pair in zip(nodes, nodes[1:], strict=False))
    shared = {pair: n for pair, n in counts.items() if n > 1}
    if not shared:
        return {}
    joined = shared
    while True:  # what does not find two items beside the others is left to a later round
        used = Counter(pair for nodes in lists for pair in _chosen(nodes, joined))
        if len(used) == len(joined) and min(used.values()) > 1:
            return joined
        joined = {pair: n for pair, n in joined.items() if used[pair] > 1}
        if not joined:  # each stands in the way of another: the most shared alone
            best = max(shared, key=lambda pair: (shared[pair], pair))
            return {best: shared[best]}


def _chosen(nodes: list[int], shared: dict[tuple[int, int], int]) -> list[tuple[int, int]]:
    """Pairs of a list that do not overlap, a pair giving way to a more shared one that starts at its second node."""
    out, at = [], 0
    while at + 1 < len(nodes):
        here = shared.get((nodes[at], nodes[at + 1]), 0)
        after = shared.get((nodes[at + 1], nodes[at + 2]), 0) if at + 2 < len(nodes) else 0
        if here and here >= after:
            out.append((nodes[at], nodes[at + 1]))
            at += 2
        else:
            at += 1
    return out


def mine(ids: list, bags: list[dict[bytes, int]]) -> Plan:
    """The plan for items with these bags of terms."""
    holders: dict[Atom, list[int]] = {}
    for item, bag in enumerate(bags):
        for atom in sorted(bag.items()):
            holders.setdefault(atom, []).append(item)
    groups: dict[tuple[int, ...], int] = {}
    terms: dict[bytes, list[tuple[int, int]]] = {}
    for (term, times), items in holders.items():
        terms.setdefault(term, []).append((groups.setdefault(tuple(items), len(groups)), times))
    lists: list[list[int]] = [[] for _ in bags]
    for items, group in sorted(groups.items(), key=lambda g: (-len(g[0]), g[1])):
        for item in items:
            lists[item].append(group)
    children: list[tuple[int, int]] = []
    while joined := _pairs_to_join(lists):
        node_of = {}
        for pair in sorted(joined):
            node_of[pair] = len(groups) + len(children)
            children.append(pair)
        for item, nodes in enumerate(lists):
            pairs, out, at = _chosen(nodes, joined), [], 0
            for pair in pairs:
                while nodes[at] != pair[0]:
                    out.append(nodes[at])
                    at += 1
                out.append(node_of[pair])
                at += 2
            lists[item] = out + nodes[at:]
    return _levelled(ids, terms, len(groups), children, lists)


def _levelled(ids: list, terms: dict[bytes, list[tuple[int, int]]], n_classes: int, children: list[tuple[int, int]], lists: list[list[int]]) -> Plan:
    """The plan with its nodes numbered by level."""
    height = [0] * n_classes
    for a, b in children:  # a node comes after its two
        height.append(1 + max(height[a], height[b]))
    order = sorted(range(len(height)), key=lambda n: (height[n], n))
    number = {old: new for new, old in enumerate(order)}
    levels: list[tuple[list[int], list[int]]] = [([], []) for _ in range(max(height, default=0))]
    for old in order[n_classes:]:
        for side, child in zip(levels[height[old] - 1], children[old - n_classes], strict=True):
            side.append(number[child])
    return Plan(ids, list(terms), list(terms.values()), n_classes, levels, [[number[n] for n in nodes] for nodes in lists])


class Accumulators:
    """A plan with its terms' weights, ready to score runs of documents."""

    def __init__(self, plan: Plan, weights: list[int], docs: int, words: int) -> None:
        self.plan, self.docs, self.words = plan, docs, words
        self.weight = np.array(weights, np.int64)
        counts = [len(c) for c in plan.classes]
        self.first = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        self.classes = np.array([c for held in plan.classes for c, _ in held], np.int64)
        self.times = np.array([n for held in plan.classes for _, n in held], np.int64)
        self.levels = [(np.array(a, np.int64), np.array(b, np.int64)) for a, b in plan.levels]
        self.scored = [i for i, nodes in enumerate(plan.lists) if nodes]
        self.nodes = np.array([n for i in self.scored for n in plan.lists[i]], np.int64)
        self.starts = np.cumsum([0, *(len(plan.lists[i]) for i in self.scored)], dtype=np.int64)[:-1]
        self.run = int(max(16, min(RUN_DOCS, RUN_BYTES // (8 * (plan.n_nodes + len(self.nodes) + 1)))))

    def scores(self, sizes: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Of a run of documents with these numbers of terms, whose entries are (document, term, occurrences): a row for each scored item."""
        m = 100 - 75 + 75 * sizes * self.docs // max(1, self.words)
        worth = self.weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
        held = np.diff(self.first)[term]
        entry = np.repeat(np.arange(len(term)), held)
        at = np.arange(len(entry)) - np.repeat(np.cumsum(held) - held, held) + np.repeat(self.first[:-1][term], held)
        nodes = np.zeros((self.plan.n_nodes, len(sizes)), np.int64)
        np.add.at(nodes.reshape(-1), self.classes[at] * len(sizes) + doc[entry], worth[entry] * self.times[at])
        made = self.plan.n_classes
        for left, right in self.levels:
            np.add(nodes[left], nodes[right], out=nodes[made : made + len(left)])
            made += len(left)
        return np.add.reduceat(nodes[self.nodes], self.starts, axis=0)


def _best(scores: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(item, document) of the k best of each item, documents being in order; ``least``, an item's k-th best so far, is raised."""
    if scores.shape[1] >= k:
        np.maximum(least, np.partition(scores, -k, axis=1)[:, -k], out=least)
    item, doc = np.nonzero(scores >= least[:, None])
    order = np.lexsort((doc, -scores[item, doc], item))
    item, doc = item[order], doc[order]
    start = np.searchsorted(item, item)
    kept = np.arange(len(item)) - start < k
    return item[kept], doc[kept]


def _plans(items: DataFrame) -> list[Plan]:
    """The items in blocks, mined each in one task; a block's plan comes to the driver, which sends it on."""
    rows = items.select(F.col("item_id").alias("item"), "text").distinct()
    rows = written(rows.select("item", "text", F.xxhash64("item", "text").alias("place")), "search-items")
    n, size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    blocks = max(1, -(-n // ITEMS), -(-(size or 0) // ITEM_BYTES))
    rows = rows.withColumn("block", F.pmod("place", F.lit(blocks)))

    def plan(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("place")
        ids = [None if pd.isna(i) else i for i in block["item"].tolist()]
        bags = [term_counts(None if t is None else t.encode("utf-8", "replace")) for t in block["text"]]
        return pd.DataFrame({"block": block["block"].iloc[:1], "plan": [pickle.dumps(mine(ids, bags))]})

    mined = written(rows.groupBy("block").applyInPandas(plan, "block long, plan binary"), "search-plans")
    return [pickle.loads(mined.where(F.col("block") == b).first()["plan"]) for b in sorted(r["block"] for r in mined.select("block").collect())]


def occurrences(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """(doc_id, size, terms, tfs) of every document: its number of terms of any kind, and which of ``terms`` it has how often."""
    spark = docs.sparkSession
    number = spark.sparkContext.broadcast({t: i for i, t in enumerate(terms)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.value
        wanted = known.keys()
        for batch in (part for whole in batches for part in slices(whole, "text", SLICE_BYTES)):
            sizes, held, tfs = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                counts = term_counts(text)
                found = sorted((known[t], counts[t]) for t in wanted & counts.keys())
                sizes.append(counts.total())
                held.append([t for t, _ in found])
                tfs.append([n for _, n in found])
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(held, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "size", "terms", "tfs"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", "text").mapInArrow(count, f"doc_id {kind}, size long, terms array<int>, tfs array<long>")
    return written(counted, "search-counts")


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _candidates(counted: DataFrame, plan: Plan, k: int, block: int, item_type: str) -> DataFrame:
    """(_item, item_id, doc_id, score): of each task's documents, rows that hold each item's k best."""
    docs, words = counted.agg(F.count_if(F.col("size") > 0), F.coalesce(F.sum("size"), F.lit(0))).first()
    holding = dict(counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1))).collect())  # as many rows as the plan has terms
    scorer = counted.sparkSession.sparkContext.broadcast((plan, [term_weight(docs, holding.get(i, 0)) for i in range(len(plan.terms))], docs, words))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Accumulators(*scorer.value)
        if not made.scored:
            return
        least = np.ones(len(made.scored), np.int64)  # scores of 0 are no results
        ids = [made.plan.items[i] for i in made.scored]
        for whole in batches:
            whole = whole.take(pa.compute.sort_indices(whole.column("doc_id")))
            for start in range(0, whole.num_rows, made.run):
                batch = whole.slice(start, made.run)
                terms, tfs = batch.column("terms"), batch.column("tfs")
                doc = np.repeat(np.arange(batch.num_rows), terms.value_lengths().to_numpy())
                flat = (terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy())
                scores = made.scores(batch.column("size").to_numpy(), doc, *flat)
                item, found = _best(scores, k, least)
                out = {
                    "_item": pa.array([(block << 32) + made.scored[i] for i in item], pa.int64()),
                    "item_id": pa.array([ids[i] for i in item], item_arrow),
                    "doc_id": batch.column("doc_id").take(pa.array(found, pa.int64())),
                    "score": pa.array(scores[item, found], pa.int64()),
                }
                yield pa.RecordBatch.from_pydict(out)

    item_arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[item_type]
    kind = counted.schema["doc_id"].dataType.simpleString()
    return counted.mapInArrow(score, f"_item long, item_id {item_type}, doc_id {kind}, score long")


def rank(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item, scores above 0, ties by ascending doc_id (nulls last).

    ``docs``: doc_id and text; ``items``: item_id (long, int or string) and text; other columns are not used. Null and empty texts have no terms: such a
    document is in no result and not counted, such an item has none. Repeated documents are documents each; repeated items are one, other texts
    under an item's id are items of their own (each with ranks from 1). Very long texts are counted a MiB at a time. Empty tables give no rows.
    """
    found, item_type = None, items.schema["item_id"].dataType.simpleString()
    for block, plan in enumerate(_plans(items)):
        part = _candidates(occurrences(docs, plan.terms), plan, k, block, item_type)
        found = part if found is None else found.unionByName(part)
    if found is None:
        kind = docs.schema["doc_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {item_type}, rank int, doc_id {kind}, score long")
    best_first = Window.partitionBy("_item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
