"""Exact top-k by inner product with Fagin's threshold algorithm.

Vectors are dealt to shards; each shard has one list per dimension, sorted by value. For a query the lists are read from
the end that its weight favours; at each step those whose next rows lower the bound most. Rows met for the first time are scored in full.
No unseen row can score more than the sum of weight x value at the reached depths; reading stops when the k-th best score is above that
bound. Once half of a shard has been met its other rows are scored in one product, as the lists would only lead to them one by one. The shards'
best meet in a window per query, cut to k before the shuffle.

Queries go to blocks and every (block, run of shards) pair is one group, so neither side is broadcast. A vector is copied once for
every ``BLOCK_QUERIES`` queries. Within a run a query takes the k-th best score that it has found on to the next shard.
Vectors that are null or hold a null, NaN or infinite component take no part, neither as queries nor as candidates; the same goes for
a null id. Scaled components are cut to 62 bits and scores to 64; below, they are exact. A vector is compared with those of its own length (empty ones score 0). Ties go to the smaller id; rows that
share an id are ranked each. No valid vectors: an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallybook.llm.common import staged

#: Rows of a shard, shards of a run, queries of a block, and rows that a step reads of a list.
SHARD_ROWS, RUN_SHARDS, BLOCK_QUERIES, STEP = 2048, 8, 16384, 8
MOST, EXACT = float(1 << 62), float(1 << 53)
LONG = (-(1 << 63), (1 << 63) - 1)


def scaled(vectors: DataFrame, factor: int = 1024) -> DataFrame:
    """vec_id, x: floor(factor * component) of each vector without a null or non-finite component."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & ~bad)
            .select("vec_id", F.transform("x", lambda v: F.floor(F.greatest(F.lit(-MOST), F.least(F.lit(MOST), v * factor)))).alias("x")))


class Lists:
    """The sorted lists of one shard. Values are doubles where these hold them exactly."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        at = np.argsort(ids, kind="stable")  # places in the order of the ids, for ties
        self.most = float(np.abs(x.astype(np.float64)).max(initial=0))
        self.ids, self.x = ids[at], x[at].astype(np.float64) if self.most < EXACT else x[at]
        self.order = np.argsort(self.x, axis=0, kind="stable")

    def top(self, q: np.ndarray, k: int, own: int, floor: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """ids and scores of the k best for ``q``, without the id ``own``; rows that score less than ``floor`` may be left out."""
        n = len(self.ids)
        dims = np.flatnonzero(q)
        up, kind = q[dims] > 0, float
        if self.most * float(np.abs(q.astype(np.float64)).sum()) >= EXACT:  # sums beyond doubles: Python's whole numbers
            kind = object
        q = q.astype(kind)
        w = q[dims]
        seen = self.ids == own
        best, score = np.zeros(0, np.int64), np.zeros(0, kind)
        depth = np.zeros(len(dims), np.int64)

        def entry(at, lists):  # rows at these depths of the lists
            return self.order[np.where(up[lists], n - 1 - at, at), dims[lists]]

        def met(new):
            nonlocal best, score
            seen[new] = True
            x = self.x[new]
            best, score = np.concatenate([best, new]), np.concatenate([score, (x if kind is float else x.astype(np.int64).astype(object)) @ q])
            keep = np.lexsort((best, -score))[:k]
            best, score = best[keep], score[keep]
        every = np.arange(len(dims))
        while len(dims):
            edge = self.x[entry(np.maximum(depth - 1, 0), every), dims].astype(kind) * w
            bound = edge.sum()
            if (depth > 0).all() and (len(best) == k and score[-1] > bound or floor is not None and floor > bound):
                break
            if 2 * seen.sum() >= n:
                met(np.flatnonzero(~seen))
                break
            to = np.minimum(depth + STEP, n)
            gain = edge - self.x[entry(to - 1, every), dims].astype(kind) * w
            go = np.flatnonzero((gain >= np.median(gain.astype(float))) | (depth == 0))
            new = np.unique(entry(np.minimum(depth[go, None] + np.arange(STEP), n - 1), go[:, None]))
            depth[go] = to[go]
            met(new[~seen[new]])
        if not len(dims):  # every score is 0
            best = np.flatnonzero(~seen)[:k]
            score = np.zeros(len(best), np.int64)
        return self.ids[best], np.array([min(max(int(v), LONG[0]), LONG[1]) for v in score], np.int64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score of the k best of ``vectors`` for each row of ``queries`` (both vec_id, x)."""
    vectors, queries = staged(vectors, "vectors"), staged(queries, "queries")
    run_rows = SHARD_ROWS * RUN_SHARDS
    runs, blocks = max(1, -(-vectors.count() // run_rows)), max(1, -(-queries.count() // BLOCK_QUERIES))

    def dealt(df, own, of, other, others):
        each = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return df.select("vec_id", "x", F.size("x").alias("dims"), F.pmod(F.xxhash64("vec_id"), F.lit(of)).cast("int").alias(own), each.alias(other))

    def search(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        wanted = [(own, np.asarray(x, np.int64)) for own, x in zip(q["vec_id"], q["x"])]
        found: list[list[tuple[int, int]]] = [[] for _ in wanted]
        for at in range(0, len(v) if wanted else 0, SHARD_ROWS):
            shard = v.iloc[at:at + SHARD_ROWS]
            lists = Lists(shard["vec_id"].to_numpy(np.int64), np.stack(shard["x"].to_list()).astype(np.int64))
            for i, (own, x) in enumerate(wanted):
                ids, score = lists.top(x, k, own, found[i][-1][0] * -1 if len(found[i]) == k else None)
                found[i] = sorted(found[i] + [(-s, d) for s, d in zip(score.tolist(), ids.tolist())])[:k]
        rows = [(own, d, -s) for (own, _), best in zip(wanted, found) for s, d in best]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"], dtype="int64")
    key = ["dims", "block", "run"]
    found = (dealt(queries, "block", blocks, "run", runs).groupBy(*key)
             .cogroup(dealt(vectors, "run", runs, "block", blocks).groupBy(*key))
             .applyInPandas(search, "query_id long, vec_id long, score long"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
