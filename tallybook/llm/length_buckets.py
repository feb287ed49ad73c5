"""Packing into length buckets of least padding.

Documents are cut into pieces of at most ``MAX_LENGTH`` tokens (the end id included). Dynamic programming over the
global histogram of piece lengths chooses ``BUCKETS`` lengths so that padding every piece to the next of them adds as few
tokens as possible. Inside each bucket pieces follow one another in doc_id order, and as many as the token budget
holds form a batch. The place in a bucket comes from a range partition with offsets, so a bucket that holds most
of the rows spreads over many tasks.

A null or empty text gives one piece with just the end id. Null doc_ids come first; rows that share a doc_id are packed
each by itself. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import give_back, ranked, staged, text_slices
from tallybook.llm.rans import SLICE, PieceIds

MAX_LENGTH, BUCKETS, BUDGET = 2048, 16, 1 << 16


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """The at most ``buckets`` lengths to pad to that add the fewest tokens; ``lengths`` ascend."""
    n = len(lengths)
    if not n:
        return []
    rows, tokens = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(lengths * counts)])
    best, back = np.full(n + 1, np.inf), []
    best[0] = 0
    for _ in range(min(buckets, n)):
        new, choice = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        new[0] = 0
        for j in range(1, n + 1):  # lengths[i:j] are padded to lengths[j - 1]
            cost = best[:j] + lengths[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            choice[j] = int(np.argmin(cost))
            new[j] = cost[choice[j]]
        best = new
        back.append(choice)
    out, j = [], n
    for choice in reversed(back):
        if j:
            out.append(int(lengths[j - 1]))
            j = int(choice[j])
    return out[::-1]


def token_counts(docs: DataFrame, tokenizer: str, added: bool = False) -> DataFrame:
    """doc_id, n_tokens with the end id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        pieces = PieceIds(tokenizer, added)  # not kept: Python workers go on to other stages
        for b in batches:
            for part in text_slices(b, "text", SLICE):
                ids, which, sizes = pieces.encode_units(part.column("text").fill_null(""))
                n = np.fromiter(map(len, ids), np.int64, len(ids))[which] // pieces.kind.itemsize
                n = np.add.reduceat(n, np.cumsum(sizes) - sizes) + 1
                yield pa.record_batch([part.column("doc_id"), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])
                del ids, which
        del pieces
        give_back()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long")


def pack(docs: DataFrame, tokenizer: str, max_length: int = MAX_LENGTH, buckets: int = BUCKETS, budget: int = BUDGET, added: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, n_tokens, bucket (the padded length), batch, slot."""
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_tokens") - 1, F.lit(max_length).cast("long")))
    pieces = token_counts(docs, tokenizer, added).select("doc_id", "n_tokens", start.alias("start")).select(
        "doc_id", (F.col("start") / max_length).cast("int").alias("piece"), "start", F.least(F.col("n_tokens") - F.col("start"), F.lit(max_length).cast("long")).alias("n_tokens"))
    pieces = staged(pieces, "pieces")
    return batches_of(pieces, bounds_of(pieces, buckets), budget)


def bounds_of(pieces: DataFrame, buckets: int = BUCKETS) -> list[int]:
    hist = sorted(pieces.groupBy("n_tokens").count().collect())  # at most max_length rows
    return boundaries(np.array([h[0] for h in hist], np.int64), np.array([h[1] for h in hist], np.int64), buckets)


def batches_of(pieces: DataFrame, bounds: list[int], budget: int = BUDGET) -> DataFrame:
    """``pieces`` with bucket, batch and slot; a batch holds at most budget / bucket pieces (one at least)."""
    bucket = F.lit(None).cast("long")
    for b in reversed(bounds):
        bucket = F.when(F.col("n_tokens") <= b, F.lit(b).cast("long")).otherwise(bucket)
    rows = ranked(pieces.withColumn("bucket", bucket), [F.col(c) for c in ("bucket", "doc_id", "piece")], "packed", ["bucket"])
    each = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.col("bucket")))
    return rows.select("doc_id", "piece", "start", "n_tokens", "bucket", F.floor(F.col("rank") / each).alias("batch"), (F.col("rank") % each).cast("int").alias("slot"))
