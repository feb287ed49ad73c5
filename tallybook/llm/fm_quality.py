"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

    z = w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)

The last term is the sum over all pairs of <v_i, v_j> x_i x_j, in time linear in the number of features. Words are hashed to
``WORDS`` places and weighted by log(1 + count), scaled to length 1; the statistics come from the whole text; the metadata is the declared
number of characters (its size and whether it is true). It is fitted by AdaGrad on at most about ``MAX_TRAIN`` labelled rows.

Null and empty texts have no words and statistics of 0, and get a score like any other. A null n_chars counts as the text's own length.
Rows that share a doc_id get one row each. Without labels every score is 0.5. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm import federated
from tallybook.llm.common import Kept, give_back

WORDS, FACTORS = 1 << 16, 8
MAX_TRAIN, ROUNDS, RATE, DECAY = 24_000, 8, 0.15, 1e-6
STATISTICS = ("capitals", "digits", "signs", "bars", "exclamations", "spaces", "breaks", "other bytes", "words", "word length", "distinct words", "most frequent word",
              "repeated lines", "bare words", "words again", "doubled signs", "characters", "declared characters", "declared otherwise", "one")
_KINDS = np.zeros((256, 8), np.float64)
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#$%&*+/<=>@[\\]^_`{}~", b"|", b"!", b" ", b"\n\r\t", bytes(range(128, 256)))):
    _KINDS[list(_chars), _k] = 1


_PLACES = Kept(lambda word: xxhash.xxh3_64_intdigest(word) % WORDS)


def features(text: str | None, declared: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's features."""
    text = text or ""
    data = text.encode()
    words = data.lower().split()
    places, counts = np.unique(np.fromiter(map(_PLACES.__getitem__, words), np.int64, len(words)), return_counts=True)
    x = np.log1p(counts)
    x /= np.sqrt(x @ x) or 1
    n = max(1, len(data))
    share = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _KINDS / n
    lines, seen = data.split(b"\n"), np.frombuffer(data, np.uint8)
    doubled = np.count_nonzero((seen[1:] == seen[:-1]) & (_KINDS[seen[1:], 2:5].any(axis=1))) / n if len(data) > 1 else 0
    k = max(1, len(words))
    declared = len(text) if declared is None or declared != declared else declared
    stats = [*(share * (1, 4, 4, 8, 8, 2, 4, 1)), np.log1p(len(words)) / 8, min(2, len(data) / k / 8), len(places) / k, counts.max() / k if len(counts) else 0,
             1 - len(set(lines)) / len(lines), sum(map(bytes.isalpha, words)) / k, sum(map(bytes.__eq__, words[1:], words)) / k, 4 * doubled, np.log1p(len(text)) / 10, np.log1p(max(0, declared)) / 10, float(declared != len(text)), 1]
    return np.concatenate([places, np.arange(WORDS, WORDS + len(stats))]), np.concatenate([x, stats]).astype(np.float32)


def machine(params: list[np.ndarray], idx: np.ndarray, x: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """z of each row (rows begin at ``ends``, none is empty), and the sums of v x."""
    w0, w, v = params
    vx = v[idx] * x[:, None]
    sums = np.add.reduceat(vx, ends)
    return w0[0] + np.add.reduceat(w[idx] * x, ends) + 0.5 * ((sums ** 2).sum(1) - np.add.reduceat((vx ** 2).sum(1), ends)), sums


def start_params(seed: int = 1) -> list[np.ndarray]:
    n = WORDS + len(STATISTICS)
    return [np.zeros(1, np.float32), np.zeros(n, np.float32), np.random.default_rng(seed).normal(0, 0.02, (n, FACTORS)).astype(np.float32)]


def epoch(params: list[np.ndarray], rows: pa.Table, turn: int, batch: int = 32) -> list[np.ndarray]:
    w0, w, v = params
    gw, gv, g0 = np.full(len(w), 1e-2), np.full(v.shape, 1e-2), 1.0
    idx, val, y = rows.column("idx").to_pylist(), rows.column("val").to_pylist(), rows.column("label").to_numpy().astype(np.float64)
    order = np.random.default_rng(turn).permutation(len(y))
    for at in range(0, len(order), batch):
        some = order[at:at + batch]
        parts, xs = [np.frombuffer(idx[i], np.int32) for i in some], [np.frombuffer(val[i], np.float32) for i in some]
        sizes = np.array([len(p) for p in parts])
        i, x = np.concatenate(parts), np.concatenate(xs)
        z, sums = machine(params, i, x, np.cumsum(sizes) - sizes)
        e = np.repeat(1 / (1 + np.exp(-z)) - y[some], sizes) / len(some)
        places, inverse = np.unique(i, return_inverse=True)
        dw = np.bincount(inverse, e * x, len(places)) + DECAY * w[places]
        each = (e * x)[:, None] * (np.repeat(sums, sizes, axis=0) - v[i] * x[:, None])
        dv = np.stack([np.bincount(inverse, each[:, f], len(places)) for f in range(v.shape[1])], 1) + DECAY * v[places]
        gw[places] += dw ** 2
        gv[places] += dv ** 2
        g0 += e.sum() ** 2
        w[places] -= RATE * dw / np.sqrt(gw[places])
        v[places] -= RATE / 4 * dv / np.sqrt(gv[places])
        w0[0] -= RATE * e.sum() / np.sqrt(g0)
    return [w0, w, v]


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality") -> list[np.ndarray]:
    sample = federated.labelled_sample(docs, labels, label, learn, MAX_TRAIN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [features(t, n) for t, n in zip(b.column("text").to_pylist(), b.column("n_chars").to_pylist())]
            yield pa.record_batch([pa.array([i.astype(np.int32).tobytes() for i, _ in got], pa.binary()), pa.array([x.tobytes() for _, x in got], pa.binary()), b.column("label"), b.column("shard")],
                                  ["idx", "val", "label", "shard"])
        _PLACES.clear()
        give_back()
    rows = sample.select("text", F.col("n_chars").cast("double").alias("n_chars"), F.col("_label").cast("double").alias("label"), F.pmod(F.xxhash64("doc_id"), F.lit(federated.SHARDS)).cast("int").alias("shard"))
    return federated.train(federated.dealt(rows.mapInArrow(run, "idx binary, val binary, label double, shard int")), start_params(), epoch, ROUNDS)


def score(docs: DataFrame, params: list[np.ndarray]) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(params)

    @F.pandas_udf("double")
    def scored(text: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, declared in text:
            out = []
            for at in range(0, len(texts), 256):
                got = [features(t, n) for t, n in zip(texts[at:at + 256], declared[at:at + 256])]
                sizes = np.array([len(i) for i, _ in got])
                z, _ = machine(shared.value, np.concatenate([i for i, _ in got]), np.concatenate([x for _, x in got]), np.cumsum(sizes) - sizes)
                out.append(1 / (1 + np.exp(-z.astype(np.float64))))
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))
        _PLACES.clear()
        give_back()
    return scored("text", F.col("n_chars").cast("double"))
