"""Hard negatives from Hilbert-ordered blocks with zone maps; exact.

The rows of each label are put in the order of a Hilbert curve through all dimensions (``BITS`` bits each) and cut, by exact places, into blocks of
``BLOCK_ROWS``. A block is one row of the stored table: its zone map (least and greatest value of each dimension) beside its ids and
vectors, so that bounds are computed from a scan of the zone maps alone. Anchors are ordered and cut in the same way, into groups.

The inner product of an anchor with any row of a block lies between two sums that interval arithmetic gives from the zone map. So

1. each anchor reads the block that holds it: its fifth best row of the same label so far is a floor;
2. of the other blocks of its label it reads those whose upper bound reaches the floor; the best of all that it read are its positives;
3. each positive opens a window of scores; of the blocks of other labels it reads those whose bounds overlap one of its windows.

A read is a (group, block) pair that at least one anchor of the group needs; other anchors of the group skip the block. Pairs are dealt out over
tasks by both numbers, a cell holds one group and one block at most, and what cells find is cut to k per anchor (and window) before it is shuffled. No pair is
dropped: where zone maps exclude nothing, as with vectors spread evenly in many dimensions, every block is read.

Rows with a null id or label, a null vector, or a null or non-finite component take no part. Components whose scaled value does not fit in 62 bits
are cut to that, and scores to 64 bits; below, scores are exact. A vector is compared with those of its own length. Rows with the anchor's id are
never its positives or negatives; an id that several rows carry is one anchor, the row with the smallest label and vector. Ties go to the smaller id. Only
the three columns are read, so others may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallybook.llm.common import apart, ranked, staged

BLOCK_ROWS, GROUP_ANCHORS, ZONES, BITS = 512, 1024, 1024, 4
MOST = float(1 << 62)


def scaled(vectors: DataFrame, label: Column, factor: int) -> DataFrame:
    """vec_id, label, x: floor(factor * component) of the rows that take part."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), x.alias("x"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~bad)
    return rows.select("vec_id", "label", F.transform("x", lambda v: F.floor(F.greatest(F.lit(-MOST), F.least(F.lit(MOST), v * factor)))).alias("x"))


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """The rows' places on the Hilbert curve through a grid of ``bits`` bits a dimension, as byte strings in the curve's order (after Skilling)."""
    x = x.astype(np.uint32).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):  # undo the turns of the sub-cubes
        low = np.uint32((1 << b) - 1)
        for i in range(n):
            on = (x[i] >> np.uint32(b) & 1).astype(bool)
            swap = np.where(on, 0, (x[0] ^ x[i]) & low).astype(np.uint32)
            x[0] ^= np.where(on, low, swap).astype(np.uint32)
            x[i] ^= swap
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], np.uint32)
    for b in range(bits - 1, 0, -1):
        t ^= np.where(x[n - 1] >> np.uint32(b) & 1, np.uint32((1 << b) - 1), np.uint32(0))
    x ^= t
    planes = [(x[i] >> np.uint32(b) & 1).astype(np.uint8) for b in range(bits - 1, -1, -1) for i in range(n)]
    return np.packbits(np.stack(planes, axis=1), axis=1)


def curve_keys(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` (vec_id, label, x) with dims and key, the place on the curve through the cube of side 2 * most."""
    def run(batches):
        for b in batches:
            p = b.to_pandas()
            key = pd.Series([b""] * len(p), index=p.index, dtype=object)
            for dims, same in p.groupby(p["x"].map(len)):
                if dims:
                    cell = np.floor((np.stack(same["x"].to_list()).astype(float) / (most + 1) + 1) * (1 << BITS) / 2).astype(np.int64)
                    key[same.index] = [r.tobytes() for r in hilbert(np.clip(cell, 0, (1 << BITS) - 1), BITS)]
            yield from pa_batches(p.assign(dims=p["x"].map(len).astype("int32"), key=key))
    return rows.mapInArrow(run, "vec_id long, label long, x array<long>, dims int, key binary")


def pa_batches(p: pd.DataFrame):
    return pa.Table.from_pandas(p, preserve_index=False).to_batches()


def _packed(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    """One row for each value of ``key``: ids, labels and matrix as bytes, low and high of each dimension."""
    def pack(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["rank"])
        x = np.stack(g["x"].to_list()).astype(np.int64)
        kept = {k: [g[k].iloc[0]] for k in key}
        return pd.DataFrame(kept | {"ids": [g["vec_id"].to_numpy(np.int64).tobytes()], "labels": [g["label"].to_numpy(np.int64).tobytes()], "homes": [g["home"].to_numpy(np.int64).tobytes()],
                                    "rows": [x.tobytes()], "low": [x.min(axis=0).tolist() if x.size else []], "high": [x.max(axis=0).tolist() if x.size else []]})
    types = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in key)
    return staged(rows.groupBy(*key).applyInPandas(pack, f"{types}, ids binary, labels binary, homes binary, rows binary, low array<long>, high array<long>"), name)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two integer matrices, exact within 64 bits and cut to them."""
    top = float(a.shape[1] or 1) * float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0))
    if top < 2.0 ** 52:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)  # every partial sum is a whole number below 2^53
    if top < 2.0 ** 62:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``a`` and each zone map: what an inner product with any row of that zone is at least and at most."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    least, most = _outward(up, low) + _outward(down, high), _outward(up, high) + _outward(down, low)
    slack = 1e-12 * (_outward(up - down, np.maximum(np.abs(low.astype(float)), np.abs(high.astype(float)))))
    return least - slack, most + slack


def _outward(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.float64) @ b.astype(np.float64).T


class Group:
    """The anchors of one group, with what ``mine`` has found for them so far."""

    def __init__(self, row: pd.Series):
        self.ids, self.labels, self.homes = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "homes"))
        self.x = np.frombuffer(row["rows"], np.int64).reshape(len(self.ids), -1)
        if "floors" in row:
            self.floors = np.array([np.nan if f is None else f for f in row["floors"]], float)
        if "lows" in row:
            self.lows, self.highs = (np.frombuffer(row[c], np.int64).reshape(len(self.ids), -1) for c in ("lows", "highs"))

    def needs(self, zones: pd.DataFrame, want: str) -> np.ndarray:
        """[anchor, zone]: whether the anchor must read that block."""
        low, high = (np.array(zones[c].to_list(), np.int64).reshape(len(zones), -1) for c in ("low", "high"))
        least, most = bounds(self.x, low, high)
        same = self.labels[:, None] == zones["label"].to_numpy(np.int64)
        if want == "positives":
            reach = np.isnan(self.floors)[:, None] | (most >= self.floors[:, None])
            return same & reach & (self.homes[:, None] != zones["block"].to_numpy(np.int64))
        open_ = np.zeros(same.shape, bool)
        for lo, hi in zip(self.lows.T, self.highs.T):
            open_ |= (lo <= hi)[:, None] & (most >= lo[:, None]) & (least <= hi[:, None])
        return ~same & open_


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by smaller id."""
    if len(score) > k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
        return at[np.lexsort((ids[at], -score[at]))[:k]]
    return np.lexsort((ids, -score))


def mine(rows: DataFrame, anchors: DataFrame, k_positive: int = 5, k_negative: int = 3, least: int = 50, most: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; ``rows`` and ``anchors`` have vec_id, label, x, and
    least * positive_score <= 100 * negative_score <= most * positive_score."""
    rows = staged(rows, "rows")
    side = rows.agg(F.max(F.array_max(F.transform("x", lambda v: F.greatest(v, -v))))).first()[0] or 0
    keyed = ranked(curve_keys(rows, side), [F.col(c) for c in ("dims", "label", "key", "vec_id", "x")], "curve", ["dims", "label"])
    blocks = keyed.withColumn("block", F.xxhash64("dims", "label", F.floor(F.col("rank") / BLOCK_ROWS))).withColumn("home", F.col("block"))
    zones = _packed(blocks, ["dims", "block"], "blocks").withColumn("label", F.expr("conv(hex(reverse(substring(labels, 1, 8))), 16, -10)").cast("long"))
    zones = staged(zones, "zones")

    chosen = anchors.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("a")).select("vec_id", "a.label", "a.x")
    chosen = chosen.join(blocks.select("vec_id", "label", "x", "key", "home", "dims"), ["vec_id", "label", "x"]).dropDuplicates(["vec_id"])
    chosen = ranked(chosen, [F.col(c) for c in ("dims", "key", "vec_id")], "anchors", ["dims"])
    groups = _packed(chosen.withColumn("group", F.floor(F.col("rank") / GROUP_ANCHORS)), ["dims", "group"], "groups").drop("low", "high")

    shelves = max(1, -(-zones.count() // ZONES))
    cell = ["dims", "group", "block"]

    def pairs(groups: DataFrame, want: str) -> DataFrame:
        """dims, group, block of the reads that ``want`` needs, from the zone maps alone."""
        def choose(g: pd.DataFrame, z: pd.DataFrame) -> pd.DataFrame:
            if not len(g) or not len(z):
                return pd.DataFrame({c: [] for c in cell})
            needed = z["block"][Group(g.iloc[0]).needs(z, want).any(axis=0)]
            return pd.DataFrame({"dims": g["dims"].iloc[0], "group": g["group"].iloc[0], "block": needed})
        maps = zones.select("dims", "block", "label", "low", "high", F.pmod("block", F.lit(shelves)).alias("shelf"))
        left = groups.withColumn("shelf", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shelves - 1).cast("long"))))
        numbers = apart(groups.select("dims", "group").distinct())
        return staged(left.groupBy("dims", "group", "shelf").cogroup(apart(maps.join(numbers, "dims")).groupBy("dims", "group", "shelf"))
                      .applyInPandas(choose, "dims int, group long, block long"), f"{want}-reads")

    def read(groups: DataFrame, pairs: DataFrame, want: str) -> DataFrame:
        """anchor_id, window, vec_id, score: the best that each anchor finds in each block that it needs."""
        def look(g: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(g) and len(b):
                group, block = Group(g.iloc[0]), b.iloc[0]
                ids = np.frombuffer(block["ids"], np.int64)
                x = np.frombuffer(block["rows"], np.int64).reshape(len(ids), -1)
                at = np.flatnonzero(group.homes == block["block"]) if want == "home" else np.flatnonzero(group.needs(b, want)[:, 0])
                score = products(group.x[at], x)
                for a, s in zip(at, score):
                    other = ids != group.ids[a]
                    if want in ("home", "positives"):
                        i = np.flatnonzero(other)
                        i = i[_best(s[i], ids[i], k_positive)]
                        out += [(group.ids[a], 0, ids[j], s[j]) for j in i]
                        continue
                    for w, (lo, hi) in enumerate(zip(group.lows[a], group.highs[a])):
                        i = np.flatnonzero(other & (s >= lo) & (s <= hi))
                        i = i[_best(s[i], ids[i], k_negative)]
                        out += [(group.ids[a], w, ids[j], s[j]) for j in i]
            return pd.DataFrame(out, columns=["anchor_id", "window", "vec_id", "score"])
        left, right = apart(pairs).join(groups, ["dims", "group"]), apart(apart(pairs).join(zones, ["dims", "block"]))
        return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(look, "anchor_id long, window int, vec_id long, score long")

    def top(found: DataFrame, k: int) -> DataFrame:
        rank = F.row_number().over(W.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k)

    def told(groups: DataFrame, per_anchor: DataFrame, types: str, fill) -> DataFrame:
        """``groups`` with columns of one value for each anchor, from the rows of ``per_anchor`` (anchor_id, ...)."""
        ids = chosen.select("dims", F.floor(F.col("rank") / GROUP_ANCHORS).alias("group"), F.col("vec_id").alias("anchor_id"))
        rows = ids.join(per_anchor, "anchor_id")

        def put(g: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
            return g.assign(**fill(np.frombuffer(g["ids"].iloc[0], np.int64), r)) if len(g) else pd.DataFrame(columns=[f.split()[0] for f in types.split(", ")])
        return staged(groups.groupBy("dims", "group").cogroup(apart(rows).groupBy("dims", "group")).applyInPandas(put, types), "told")

    base = "dims int, group long, ids binary, labels binary, homes binary, rows binary"
    home = chosen.select("dims", F.floor(F.col("rank") / GROUP_ANCHORS).alias("group"), F.col("home").alias("block")).distinct()
    near = staged(top(read(groups, home, "home"), k_positive).drop("rank"), "near")
    floors = near.groupBy("anchor_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor")).where(F.col("n") >= k_positive).select("anchor_id", "floor")

    def fill_floors(ids, r):
        at = dict(zip(r["anchor_id"], r["floor"]))
        return {"floors": [[float(at[i]) - 0.5 - abs(float(at[i])) * 1e-15 if i in at else None for i in ids]]}
    known = told(groups, floors, base + ", floors array<double>", fill_floors)
    positives = staged(top(near.unionByName(read(known, pairs(known, "positives"), "positives")), k_positive), "positives")

    def fill_windows(ids, r):
        lows, highs = np.ones((len(ids), k_positive), np.int64), np.zeros((len(ids), k_positive), np.int64)  # no window
        at = {i: n for n, i in enumerate(ids)}
        for a, n, s in zip(r["anchor_id"], r["rank"], r["score"]):
            lows[at[a], n - 1], highs[at[a], n - 1] = -(-least * int(s) // 100), most * int(s) // 100
        return {"lows": [lows.tobytes()], "highs": [highs.tobytes()]}
    known = told(groups, positives.select("anchor_id", "rank", "score"), base + ", lows binary, highs binary", fill_windows)
    negatives = top(read(known, pairs(known, "negatives"), "negatives"), k_negative)
    positives = positives.select("anchor_id", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return negatives.join(positives, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
