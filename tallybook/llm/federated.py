"""Training on shards: each task passes over its rows from the shared parameters, and the mean of what they reach,
weighted by rows, is shared next."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import staged

SHARDS = 6


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, most: int) -> DataFrame:
    """Columns of ``docs`` and ``label`` of about ``most`` rows at most of the labelled ones in ``learn`` (a condition on doc_id),
    chosen by a hash of the doc_id. A row without label is left out; doubly labelled documents count once, with the larger label."""
    labels = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learn).groupBy("doc_id").agg(F.max(label).alias("_label"))
    n = labels.count()
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, most / max(1, n)))
    labels = F.broadcast(labels.where(part).withColumnRenamed("doc_id", "_labelled"))  # about ``most`` short rows, so no text is shuffled
    return docs.join(labels, docs["doc_id"] == labels["_labelled"]).drop("_labelled")


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` by their column ``shard``, written for :func:`train`."""
    return staged(rows.repartition(SHARDS, "shard").sortWithinPartitions("shard", F.xxhash64(*rows.columns)), "training")


def train(rows: DataFrame, params: list[np.ndarray], epoch: Callable, rounds: int, after: Callable = lambda p: p, prepare: Callable = lambda t: t) -> list[np.ndarray]:
    """``epoch(params, table, round)`` passes over a shard's rows (an Arrow table, from :func:`dealt` and through ``prepare``) and returns new parameters."""
    spark = rows.sparkSession
    if rows.isEmpty():
        return params
    shapes = [(p.shape, p.dtype) for p in params]
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(params)

        def run(batches):
            tables = [b for b in batches if b.num_rows]
            if tables:
                got = epoch([p.copy() for p in shared.value], prepare(pa.Table.from_batches(tables)), turn)
                yield pa.record_batch([pa.array([sum(t.num_rows for t in tables)], pa.int64()), pa.array([b"".join(p.tobytes() for p in got)], pa.binary())], ["n", "params"])
        got = rows.coalesce(SHARDS).mapInArrow(run, "n long, params binary").collect()  # SHARDS rows
        sums = [np.zeros(s, np.float64) for s, _ in shapes]
        for g in got:
            at = 0
            for i, (shape, kind) in enumerate(shapes):
                size = int(np.prod(shape)) * kind.itemsize
                sums[i] += g["n"] * np.frombuffer(g["params"], kind, int(np.prod(shape)), at).reshape(shape)
                at += size
        n = sum(g["n"] for g in got)
        params = after([(s / n).astype(kind) for s, (_, kind) in zip(sums, shapes)])
    return params
