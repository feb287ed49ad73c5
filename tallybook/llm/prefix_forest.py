"""Approximate nearest neighbours (largest cosine) with a forest of sorted arrays of hash strings.

A vector's string in a tree has ``SYMBOLS`` symbols; each is the number and sign of the random direction, of up to 64 orthogonal ones, that the
vector is most parallel to (cross-polytope hashing, which tells near from far better than single sign bits). Equal vectors are one entry with their
k + 1 smallest ids, so a very common vector costs one entry. Entries are dealt to shards of about ``SHARD_ROWS``; the stored
index has a row per (shard, tree) with the tree's strings in ascending order and the entries' places, and one with the shard's vectors.

Search: in every tree a query descends by binary search to the entries with its first 1, 2, ... symbols, as far as any match. Then all trees of
the shard ascend together from the longest match to shorter ones until they hold enough different entries: the shard's part of
max(``LEAST``, ``SHARE`` of all entries). At no symbol at all the whole shard is meant, so a table of up to LEAST different vectors is
searched exactly. Candidates are scored by their cosine with the query in double precision; the shards' best meet in a window cut to k before its shuffle.

Every entry is indexed and nothing is fitted. Vectors that are null, zero, or hold null, NaN or infinite components take no part, nor do
null ids. A vector is compared with those of its own length. Rows that share an id are candidates each and no candidates of that id's query; as
a query the smallest vector of the id counts. Ties go to the smaller id. Only vec_id and embedding are read, so other columns may have any name.
No valid vectors: an empty result. Recall against brute force is measured in tests/llm and given in the README; SHARE is what vectors
without any structure need, whose neighbours are hardly nearer than the rest.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallybook.llm.common import apart, staged

TREES, SYMBOLS, DIRECTIONS = 48, 6, 64
LEAST, SHARE = 2000, 0.2
SHARD_ROWS, BLOCK_QUERIES = 4096, 16384
VECTORS = -1  # in place of the tree's number


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id, x (doubles) of the vectors that take part."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
            .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & ~bad & F.exists("x", lambda v: v != 0)))


@lru_cache(4)
def directions(dims: int) -> np.ndarray:
    """dims x (trees, symbols, directions): orthonormal directions for each symbol."""
    rng, n = np.random.default_rng(20240601), min(dims, DIRECTIONS)
    sets = [np.linalg.qr(rng.standard_normal((dims, n)))[0] for _ in range(TREES * SYMBOLS)]
    return np.concatenate(sets, axis=1).astype(np.float32)


def tame(x: np.ndarray) -> np.ndarray:
    """Rows multiplied by powers of two, so that squares neither overflow nor vanish; cosines stay the same."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def strings(x: np.ndarray) -> np.ndarray:
    """The string of each row in each tree, eight bits a symbol, the first symbol highest."""
    n = min(x.shape[1], DIRECTIONS)
    out = np.zeros((len(x), TREES), np.uint64)
    for at in range(0, len(x), 256):
        y = (tame(x[at:at + 256]).astype(np.float32) @ directions(x.shape[1])).reshape(-1, TREES, SYMBOLS, n)
        best = np.abs(y).argmax(axis=3)
        sign = np.take_along_axis(y, best[..., None], axis=3)[..., 0] > 0
        for k in range(SYMBOLS):
            out[at:at + 256] |= (2 * best[:, :, k] + sign[:, :, k]).astype(np.uint64) << np.uint64(8 * (SYMBOLS - 1 - k))
    return out


def forest(vectors: DataFrame, k: int) -> DataFrame:
    """The index of ``vectors`` (vec_id, x): dims, shard, tree, n, strings, places; for the vectors themselves tree = VECTORS with rows and ids."""
    rank = F.row_number().over(W.partitionBy("x").orderBy("vec_id"))  # cut to k + 1 before the shuffle
    entries = staged(vectors.withColumn("rank", rank).where(F.col("rank") <= k + 1).groupBy("x").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "entries")
    shards = max(1, -(-entries.count() // SHARD_ROWS))

    def build(g: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(g["x"].to_list())
        s = strings(x)
        rows = [(int(g["dims"].iloc[0]), int(g["shard"].iloc[0]), VECTORS, len(x), b"", b"", x.tobytes(), [list(i) for i in g["ids"]])]
        for t in range(TREES):
            order = np.argsort(s[:, t], kind="stable")
            rows.append((*rows[0][:2], t, len(x), s[order, t].tobytes(), order.astype(np.int32).tobytes(), None, None))
        return pd.DataFrame(rows, columns=["dims", "shard", "tree", "n", "strings", "places", "rows", "ids"])
    dealt = entries.select(F.size("x").alias("dims"), F.pmod(F.xxhash64("x"), F.lit(shards)).cast("int").alias("shard"), "x", "ids")
    return staged(dealt.groupBy("dims", "shard").applyInPandas(build, "dims int, shard int, tree int, n long, strings binary, places binary, rows binary, ids array<array<long>>"), "forest")


class Shard:
    """The trees and vectors of one shard."""

    def __init__(self, rows: pd.DataFrame, dims: int):
        own = rows["tree"] == VECTORS
        self.x = tame(np.frombuffer(rows.loc[own, "rows"].iloc[0], np.float64).reshape(-1, dims))
        self.norm = np.sqrt((self.x * self.x).sum(axis=1))
        self.ids = rows.loc[own, "ids"].iloc[0]
        self.least = np.array([i[0] for i in self.ids])
        trees = rows[~own].sort_values("tree")
        self.strings = [np.frombuffer(b, np.uint64) for b in trees["strings"]]
        self.places = [np.frombuffer(b, np.int32) for b in trees["places"]]

    def descend(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For strings s[query, tree]: [query, tree, symbols] where the entries with as many of its first symbols begin and end."""
        ends = np.zeros((2, len(s), TREES, SYMBOLS + 1), np.int64)
        for t, sorted_ in enumerate(self.strings):
            for n in range(1, SYMBOLS + 1):
                unit = np.uint64(1 << 8 * (SYMBOLS - n))
                low = s[:, t] // unit * unit
                ends[0, :, t, n] = np.searchsorted(sorted_, low)
                ends[1, :, t, n] = np.searchsorted(sorted_, low + unit)
        return ends[0], ends[1]

    def ascend(self, low: np.ndarray, high: np.ndarray, budget: int) -> np.ndarray:
        """Places of the entries that all trees hold together once they are enough."""
        size, found = (high - low).sum(axis=0), np.zeros(len(self.x), bool)
        for n in range(SYMBOLS, 0, -1):
            if size[n] >= budget:
                for t in np.flatnonzero(high[:, n] > low[:, n]):
                    found[self.places[t][low[t, n]:high[t, n]]] = True
                if np.count_nonzero(found) >= budget:
                    return np.flatnonzero(found)
        return np.arange(len(self.x))

    def nearest(self, q: np.ndarray, own: int, at: np.ndarray, k: int) -> list[tuple[int, float]]:
        score = (self.x[at] * q).sum(axis=1) / (self.norm[at] * np.sqrt((q * q).sum()))
        if len(at) > k + 1:
            keep = np.flatnonzero(score >= -np.partition(-score, k)[k])
            at, score = at[keep], score[keep]
        best = np.lexsort((self.least[at], -score))[:k + 1]  # one entry more, as the query's own id may be the only one of its entry
        rows = [(-score[b], i) for b in best for i in self.ids[at[b]] if i != own]
        return [(i, -s) for s, i in sorted(rows)[:k]]


def search(vectors: DataFrame, queries: DataFrame, k: int, least: int = LEAST, share: float = SHARE) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found among ``vectors`` for each of ``queries`` (both vec_id, x)."""
    index = forest(vectors, k)

    def hashed(batches):
        for b in batches:
            x = pd.Series(b.column("x").to_pylist())
            s = [b""] * len(x)
            for _, same in x.groupby(x.map(len)):
                for i, row in zip(same.index, strings(np.stack(same.to_list()))):
                    s[i] = row.tobytes()
            yield pa.record_batch([b.column("vec_id"), b.column("x"), pa.array(s, pa.binary())], ["vec_id", "x", "strings"])
    queries = staged(queries.groupBy("vec_id").agg(F.min("x").alias("x")).mapInArrow(hashed, "vec_id long, x array<double>, strings binary"), "queries")
    total = index.where(F.col("tree") == VECTORS).agg(F.sum("n")).first()[0] or 0
    part = max(share, min(1.0, least / max(1, total)))  # of each shard
    blocks = max(1, -(-queries.count() // BLOCK_QUERIES))

    def visit(q: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(q) and len(trees):
            shard = Shard(trees, int(trees["dims"].iloc[0]))
            low, high = shard.descend(np.stack([np.frombuffer(s, np.uint64) for s in q["strings"]]))
            budget = int(np.ceil(part * len(shard.x)))
            for own, x, a, b in zip(q["vec_id"], tame(np.stack(q["x"].to_list())), low, high):
                rows += [(own, *r) for r in shard.nearest(x, own, shard.ascend(a, b, budget), k)]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])
    shards = apart(index.select("dims", "shard").distinct())
    left = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("dims", F.size("x")).join(shards, "dims")
    right = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    key = ["dims", "shard", "block"]
    found = left.groupBy(*key).cogroup(apart(right).groupBy(*key)).applyInPandas(visit, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
