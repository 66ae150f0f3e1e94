"""Exact top-k inner products by an impact-ordered index, a score at a time.

The rows are dealt into blocks. A block's index orders its postings (row, dimension, value) by quantised impact, the size of the value
in ``LEVELS`` steps, the largest first, and knows for every row and level the norm of what is left below it. A batch of queries is
scored level by level. After each level a row's score is known up to the query's norm times the row's norm left, so the k-th largest lower
bound proves which rows cannot be among the best. A query stops when few rows are left, or when no postings are; those
rows are scored again in integers. Blocks' best rows are merged by a ranking per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from clicklake.llm.common import written
from clicklake.llm.vectors import matrix, usable

SCALE = 256
LEVELS = 6
BLOCK_ROWS = 8192
QUERY_BATCH = 256
SLACK = 1e-9


class Index:
    """The postings of one block by impact level."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, levels: int = LEVELS) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        values = self.rows.astype(np.float64)
        size = np.abs(values)
        step = (size.max() if size.size else 0.0) / levels or 1.0
        impact = np.minimum((size / step).astype(int), levels - 1)
        self.segments = [np.where(impact == level, values, 0.0) for level in range(levels - 1, -1, -1)]
        left = np.stack([(s * s).sum(1) for s in self.segments])
        self.left = np.sqrt(np.vstack([left[::-1].cumsum(0)[::-1][1:], np.zeros(len(values))]))
        self.norms = np.sqrt((values * values).sum(1))

    def _exact(self, query: np.ndarray, at: np.ndarray) -> list[int]:
        rows = self.rows[at]
        if float(np.abs(query).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, len(query)) < 2.0**62:
            return (rows @ query).tolist()
        return [sum(int(a) * int(b) for a, b in zip(r, query, strict=True)) for r in rows]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """(query_id, id, score) of each query's k best rows with another id; ties go to the smaller id."""
        width = max(self.rows.shape[1], queries.shape[1])
        if self.rows.shape[1] < width:
            wide = np.zeros((len(self.rows), width), np.int64)
            wide[:, : self.rows.shape[1]] = self.rows
            self.__init__(self.ids, wide, len(self.segments))
        if queries.shape[1] < width:
            queries = np.hstack([queries, np.zeros((len(queries), width - queries.shape[1]), np.int64)])
        out, active = [], np.arange(len(queries))
        real = queries.astype(np.float64)
        size = np.sqrt((real * real).sum(1))
        scores = np.zeros((len(queries), len(self.ids)))
        own = query_ids[:, None] == self.ids[None, :]
        k_here = min(k, len(self.ids))
        for level, segment in enumerate(self.segments):
            scores[active] += real[active] @ segment.T
            doubt = size[active, None] * (self.left[level] + SLACK * self.norms)
            lower = np.where(own[active], -np.inf, scores[active] - doubt)
            proven = -np.partition(-lower, k_here - 1, axis=1)[:, k_here - 1] if k_here else np.zeros(len(active))
            possible = (scores[active] + doubt >= proven[:, None]) & ~own[active]
            done = np.ones(len(active), bool) if level == len(self.segments) - 1 else possible.sum(1) <= 16 * k
            for i in np.flatnonzero(done):
                q, at = active[i], np.flatnonzero(possible[i])
                found = sorted(zip([-s for s in self._exact(queries[q], at)], self.ids[at].tolist(), strict=True))[:k]
                out += [(int(query_ids[q]), i, -s) for s, i in found]
            active = active[~done]
            if not len(active):
                break
        return out


def top_k(rows: DataFrame, is_query: Column, k: int = 5, scale: int = SCALE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows of ``rows`` (vec_id, embedding; other columns are not used) that ``is_query`` holds for.

    Components become floor(scale * x), in the range of a long; the score is the inner product of these. Rows whose id or vector is null,
    or holds null or non-finite components, take no part; of vectors of different length the shorter one ends in zeros. A row is never its own
    candidate, nor is another row with its id; repeated rows count each. With fewer than k candidates all are given; an empty
    table or no query gives no rows.
    """
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    kept = rows.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    kept = written(kept.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")), "topk-rows")
    blocks = max(1, -(-kept.count() // block_rows))
    data = kept.select(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"), F.lit(0).alias("kind"), "vec_id", "v")
    # Every query meets every block: the stated query set against all rows.
    asked = kept.where("q").select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.lit(1).alias("kind"), "vec_id", "v")
    dealt = data.unionByName(asked).repartition(blocks, "block").sortWithinPartitions("block", "kind", "vec_id")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, index, parts = None, None, []
        for batch in batches:
            for (at, kind), some in batch.groupby(["block", "kind"], sort=True):
                if at != block:
                    block, index, parts = at, None, []
                if kind == 0:
                    parts.append(some)
                    continue
                if index is None and parts:
                    held = pd.concat(parts)
                    index, parts = Index(held["vec_id"].to_numpy(), matrix(held["v"], np.int64)), []
                for i in range(0, len(some) if index else 0, QUERY_BATCH):
                    part = some.iloc[i : i + QUERY_BATCH]
                    found = index.search(part["vec_id"].to_numpy(), matrix(part["v"], np.int64), k)
                    clipped = [(q, r, min(max(s, -(2**63)), 2**63 - 1)) for q, r, s in found]
                    yield pd.DataFrame(clipped, columns=["query_id", "vec_id", "score"]).astype("int64")

    best = dealt.mapInPandas(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
