"""Toxicity classifier with a counterfactual penalty.

Logistic regression over the presence of hashed words and word beginnings. Besides the loss on the labels it pays for every change of
the score that swapping identity terms makes: in each sentence of a labelled text that names a group, the names
are replaced by others of their list, and ``PENALTY`` times the squared change of z is added to the loss. So a group's name alone
can't carry weight, and neutral mentions aren't taken for insults. Only features whose log odds ratio between the labels is at least
``STRONG`` standard errors from 0 in grouped counts take part, so that the many harmless words of long texts don't add up
noise. Fitted on at most about ``MAX_TRAIN`` labelled rows.

Null and empty texts have no features; their score is that of the bias. Rows that share a doc_id get one row each. Without labels
every score is 0.5. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm import federated
from tallybook.llm.common import Kept

PLACES = 1 << 20
MAX_TRAIN, ROUNDS, PASSES, RATE, PENALTY, STRONG = 40_000, 4, 3, 0.5, 1.0, 4.0
#: Terms of one list stand for one another. A parameter of fit().
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"), ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab", "african", "european"), ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "locals"), ("disabled", "deaf", "blind", "elderly"),
    ("femmes", "hommes"), ("frauen", "männer"), ("mujeres", "hombres"), ("chrétiens", "musulmans", "juifs"), ("christen", "muslime", "juden"), ("cristianos", "musulmanes", "judíos"),
)
WORD, SENTENCE = re.compile(r"[^\W_]+"), re.compile(r"[^.!?\n]+")


def _parts(word: str) -> tuple[int, ...]:
    """Places of the word and of its beginnings."""
    parts = [f"={word}", *(word[:n] for n in (4, 5, 6, 7) if n <= len(word))]
    return tuple(xxhash.xxh3_64_intdigest(p.encode()) % PLACES for p in parts)


_FEATURES = Kept(_parts)


def features(words: set[str]) -> np.ndarray:
    return np.unique(np.array([p for w in words for p in _FEATURES[w]], np.int64))


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def swaps(text: str, terms=IDENTITY_TERMS) -> list[tuple[set[str], set[str]]]:
    """For each sentence with an identity term: its words, and its words after each such term became the next of its list."""
    after = {t: g[(i + 1) % len(g)] for g in terms for i, t in enumerate(g)}
    out = []
    for sentence in SENTENCE.findall(text.lower()):
        words = set(WORD.findall(sentence))
        if not after.keys().isdisjoint(words):
            out.append((words, {after.get(w, w) for w in words}))
    return out


def epoch(params: list[np.ndarray], rows: pa.Table, turn: int, penalty: float = PENALTY) -> list[np.ndarray]:
    w, b = params
    g, g0 = np.full(len(w), 0.1), 1.0
    idx, y = rows.column("idx").to_pylist(), rows.column("label").to_numpy()
    pairs = rows.column("swaps").to_pylist()
    for i in np.concatenate([np.random.default_rng(turn).permutation(len(y)) for _ in range(PASSES)]):
        x = np.frombuffer(idx[i], np.int32)
        e = 1 / (1 + np.exp(-np.clip(w[x].sum() + b[0], -30, 30))) - y[i]
        g[x] += e * e
        w[x] -= RATE * e / np.sqrt(g[x])
        g0 += e * e
        b[0] -= RATE * e / np.sqrt(g0)
        for p, q in zip(pairs[i][::2], pairs[i][1::2]):
            p, q = np.frombuffer(p, np.int32), np.frombuffer(q, np.int32)
            here, there = np.setdiff1d(p, q), np.setdiff1d(q, p)
            d = 2 * penalty * (w[here].sum() - w[there].sum()) / max(1, len(here) + len(there))
            w[here] -= d / 2
            w[there] += d / 2
    return [w, b]


def strong(rows: DataFrame) -> np.ndarray:
    """Which places tell the labels apart; at most one row per place reaches the driver."""
    def run(batches):
        n = np.zeros((2, PLACES), np.int64)
        for batch in batches:
            for x, y in zip(batch.column("idx"), batch.column("label").to_pylist()):
                n[int(y > 0), np.frombuffer(x.as_buffer(), np.int32)] += 1
        at = np.flatnonzero(n.any(axis=0))
        yield pa.record_batch([pa.array(at, pa.int32()), pa.array(n[0, at], pa.int64()), pa.array(n[1, at], pa.int64())], ["place", "n0", "n1"])
    sizes = rows.agg(F.sum((F.col("label") <= 0).cast("long")), F.sum((F.col("label") > 0).cast("long"))).first()
    counts = rows.select("idx", "label").mapInArrow(run, "place int, n0 long, n1 long").groupBy("place").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    odds = F.log((F.col("n1") + 0.5) / ((sizes[1] or 0) + 1.0)) - F.log((F.col("n0") + 0.5) / ((sizes[0] or 0) + 1.0))
    error = F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
    keep = np.zeros(PLACES, bool)
    keep[counts.where(F.abs(odds) >= STRONG * error).select("place").toPandas()["place"].to_numpy()] = True
    return keep


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", terms=IDENTITY_TERMS, penalty: float = PENALTY) -> list[np.ndarray]:
    sample = federated.labelled_sample(docs, labels, label, learn, MAX_TRAIN)
    kind = "idx binary, swaps array<binary>, label double, shard int"

    def packed(words):
        return features(words).astype(np.int32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            both = [[packed(s) for pair in swaps(t or "", terms) for s in pair] for t in texts]
            yield pa.record_batch([pa.array([packed(words_of(t)) for t in texts], pa.binary()), pa.array(both, pa.list_(pa.binary())), batch.column("label"), batch.column("shard")],
                                  ["idx", "swaps", "label", "shard"])
        _FEATURES.clear()
    rows = sample.select("text", F.col("_label").cast("double").alias("label"), F.pmod(F.xxhash64("doc_id"), F.lit(federated.SHARDS)).cast("int").alias("shard"))
    rows = federated.dealt(rows.mapInArrow(run, kind))
    kept = rows.sparkSession.sparkContext.broadcast(strong(rows))

    def cut(x: bytes) -> bytes:
        x = np.frombuffer(x, np.int32)
        return x[kept.value[x]].tobytes()

    def chosen(part: pa.Table) -> pa.Table:
        swapped = pa.array([list(map(cut, s)) for s in part.column("swaps").to_pylist()], pa.list_(pa.binary()))
        return pa.table({"idx": pa.array(map(cut, part.column("idx").to_pylist()), pa.binary()), "swaps": swapped, "label": part.column("label")})
    return federated.train(rows, [np.zeros(PLACES, np.float32), np.zeros(1, np.float32)], partial(epoch, penalty=penalty), ROUNDS, prepare=chosen)


def score(docs: DataFrame, params: list[np.ndarray]) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(params)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w, b = shared.value
        heavy = np.flatnonzero(w)
        weight = dict(zip(heavy.tolist(), w[heavy].astype(np.float64).tolist()))
        known = Kept(lambda word: tuple(p for p in _parts(word) if p in weight))

        for texts in batches:
            out = []
            for t in texts:
                places: set[int] = set()
                for word in words_of(t):
                    places.update(known[word])
                out.append(b[0] + sum(weight[p] for p in sorted(places)))
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(out, np.float64), -500, 500))))
    return scored("text")
