"""Language identification by Bayesian fusion of evidence.

    log P(language | all) = log P(text | language) + log P(declared | language) + log P(language | host) + constant

* text: naive Bayes over hashed byte trigrams, counted over all documents by declared language; as neighbouring trigrams
  depend on one another, a text counts as at most ``EFFECTIVE`` of them; counts are smoothed towards the corpus;
* declared markup language: how often documents whose text looks like a language declare it;
* host prior: languages of the host's texts, smoothed towards those of its address suffix (the last label of the host
  name), smoothed towards those of the corpus. All of it comes from one grouped count.

Languages are all that are declared; a null declaration is evidence of "other". More than ``DENSE`` of them have a sparse text
model, whose size goes with the distinct pairs of language and trigram; no table of languages by languages is made.
A document is rejected if its text has no letters, if its best language has a probability below ``SURE``, or if its trigrams are less
likely under that language than under none (each equally likely; with at least ``ENOUGH`` trigrams).

Null and empty texts are rejected with language null. A null host counts as the host "". Rows that share a doc_id get one row each.
Without any declared language everything is rejected. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import fresh, give_back, staged

BUCKETS, DENSE = 1 << 14, 64
#: Languages of which a counting task holds counts at a time, and cells (rows x languages) of a step of the verdicts.
HELD, CELLS = 64, 1 << 19
EFFECTIVE, ENOUGH = 60, 100
SURE, HOST_WEIGHT, SMOOTH = 0.5, 20.0, 2000.0
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def trigrams(text: str | None) -> np.ndarray:
    """Buckets of the byte trigrams of the text's words; empty without letters."""
    data = b" ".join((text or "").encode().translate(_LETTERS).split())
    if not data:
        return np.zeros(0, np.int64)
    x = np.frombuffer(b" " + data + b" ", np.uint8).astype(np.uint32)
    code = x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:]
    return (code * np.uint32(2654435761) >> np.uint32(18)).astype(np.int64)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1))


def declared_in(html: Column) -> Column:
    """The language that a page's html element declares; null if none."""
    code = F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1))
    return F.nullif(code, F.lit(""))


def evidence(docs: DataFrame, text: Column, declared: Column, host: Column) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns for text, declared language, host and suffix, and their names."""
    names = {k: fresh(docs, f"_{k}") for k in ("text", "declared", "host", "suffix")}
    host = F.coalesce(host.cast("string"), F.lit(""))
    suffix = F.regexp_extract(host, r"\.([^.]+)$", 1)
    return docs.select("*", *[c.alias(names[k]) for k, c in (("text", text), ("declared", declared), ("host", host), ("suffix", suffix))]), names


class TextModel:
    """log P(trigram | language) from the counts ``n`` of (language ``l``, ``bucket``): a table, or for more than DENSE languages
    what each counted pair adds to the smoothed corpus, in bucket order."""

    def __init__(self, size: int, l: np.ndarray, bucket: np.ndarray, n: np.ndarray):
        self.size, n = size, n.astype(np.float64)
        every, total = np.bincount(bucket, n, BUCKETS), np.bincount(l, n, size)
        corpus = (every + 0.1) / (n.sum() + 0.1 * BUCKETS)
        self.table = None
        if size <= DENSE:
            counts = np.zeros((size, BUCKETS))
            counts[l, bucket] = n
            self.table = np.ascontiguousarray(np.log((counts + SMOOTH * corpus) / (total[:, None] + SMOOTH)).T)
            return
        order = np.argsort(bucket, kind="stable")
        self.first = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=BUCKETS))])
        self.l, self.more = l[order].astype(np.int32), np.log1p(n / (SMOOTH * corpus[bucket]))[order]
        self.base, self.total = np.log(SMOOTH * corpus), np.log(total + SMOOTH)

    def mean(self, x: np.ndarray) -> np.ndarray:
        """Mean log likelihood of the trigrams ``x``, under each language."""
        if self.table is not None:
            return self.table[x].mean(0)
        bucket, times = np.unique(x, return_counts=True)
        first, many = self.first[bucket], self.first[bucket + 1] - self.first[bucket]
        at = np.arange(many.sum()) + np.repeat(first - (np.cumsum(many) - many), many)
        more = np.bincount(self.l[at], self.more[at] * np.repeat(times, many), self.size)
        return (more + times @ self.base[bucket]) / len(x) - self.total


def text_model(docs: DataFrame, text: str, declared: str) -> tuple[list[str], TextModel]:
    """Languages, and the model of their texts, counted over all documents; a count for each language and trigram that meet reaches the driver."""
    languages = sorted(r[0] for r in docs.where(F.col(declared).isNotNull()).select(declared).distinct().collect())
    place = {k: i for i, k in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def counted():
            for i, n in held.items():
                at = np.flatnonzero(n)
                yield pa.record_batch([pa.array(np.full(len(at), i), pa.int32()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], ["l", "bucket", "n"])
            held.clear()
        for b in batches:
            for language, t in zip(b.column(0).to_pylist(), b.column(1)):
                if language is not None:
                    i = place[language]
                    if i not in held:
                        if len(held) == HELD:
                            yield from counted()
                        held[i] = np.zeros(BUCKETS, np.int64)
                    held[i] += np.bincount(trigrams(t.as_py()), minlength=BUCKETS)
        yield from counted()
        give_back()
    counts = docs.select(declared, text).mapInArrow(run, "l int, bucket int, n long").groupBy("l", "bucket").agg(F.sum("n").alias("n")).toPandas()
    return languages, TextModel(len(languages), *(counts[c].to_numpy(np.int64) for c in ("l", "bucket", "n")))


def _likeliest(docs: DataFrame, text: str, model: TextModel) -> Column:
    """The place of the language likeliest by the text; null without letters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("int")
    def likeliest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            grams = map(trigrams, texts)
            yield pd.Series([int(np.argmax(shared.value.mean(x))) if len(x) else None for x in grams], dtype="Int32")
        give_back()
    return likeliest(text)


def _smoothed(seen: np.ndarray | None, n: np.ndarray | None, towards: np.ndarray) -> np.ndarray:
    """Shares of the languages, from the counts ``n`` of those ``seen``."""
    p = towards * HOST_WEIGHT
    if seen is None or not len(seen):
        return towards
    p[np.asarray(seen)] += n
    return p / (np.sum(n) + HOST_WEIGHT)


def identify(docs: DataFrame, text: Column, declared: Column, host: Column) -> tuple[DataFrame, str]:
    """``docs`` with a struct column (its name is returned too): language, probability, accepted."""
    rows, names = evidence(docs, text, declared, host)
    languages, model = text_model(rows, names["text"], names["declared"])
    got = fresh(rows, "_got")
    out = fresh(docs, "_language")
    if not languages:
        return docs.withColumn(out, F.struct(F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("probability"), F.lit(False).alias("accepted"))), out
    size, place = len(languages), {k: i for i, k in enumerate(languages)}
    counts = staged(rows.select(F.col(names["host"]).alias("host"), F.col(names["suffix"]).alias("suffix"), F.col(names["declared"]).alias("declared"), _likeliest(rows, names["text"], model).alias("seen"))
                    .groupBy("host", "suffix", "declared", "seen").count(), "languages")
    counts = counts.where("seen is not null")  # of the written rows: below the count it would have Spark read each text twice

    # how languages are declared: the pairs that occur, each other one counting 0.5
    pairs = [(place.get(r[0], size), r[1], r[2]) for r in counts.groupBy("declared", "seen").agg(F.sum("count").alias("n")).collect()]
    seen = np.bincount([s for _, s, _ in pairs], [n for _, _, n in pairs], size)
    said: dict[int, list] = {}
    for d, s, n in pairs:
        said.setdefault(d, []).append((s, np.log((n + 0.5) / 0.5)))
    unsaid = np.log(0.5 / (seen + 0.5 * (size + 1)))
    corpus = (seen + 1) / (seen.sum() + size)

    def tally(*key):  # at most a number for each language
        each = counts.groupBy(*key, "seen").agg(F.sum("count").alias("n"))
        return each.groupBy(*key).agg(F.collect_list(F.struct("seen", F.col("n").cast("double").alias("n"))).alias("all"))
    suffixes = tally("suffix").select("suffix", F.col("all").alias(f"{got}s"))
    priors = staged(tally("host", "suffix").join(suffixes, "suffix").select(F.col("host").alias(f"{got}k"), F.col("all").alias(f"{got}h"), f"{got}s"), "priors")
    rows = rows.join(priors, F.col(names["host"]) == F.col(f"{got}k"), "left")
    shared = docs.sparkSession.sparkContext.broadcast((model, languages, place, said, unsaid, corpus))

    @F.pandas_udf("language string, probability double, accepted boolean")
    def verdicts(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        model, languages, place, said, unsaid, corpus = shared.value

        def declaring(name):
            p = unsaid.copy()
            for s, v in said.get(place.get(name, size), ()):
                p[s] += v
            return p
        for texts, declared, host, *lists in batches:
            language, probability, accepted = np.full(len(texts), None, object), np.zeros(len(texts)), np.zeros(len(texts), bool)
            step = max(1, CELLS // size)
            for k in range(0, len(texts), step):
                got = [(k + i, len(x), model.mean(x)) for i, t in enumerate(texts.iloc[k:k + step]) if len(x := trigrams(t))]
                if not got:
                    continue
                own, many, m = np.array([i for i, *_ in got]), np.array([n for _, n, _ in got]), np.stack([v for *_, v in got])
                declarations, hosts = {}, {}
                for i in own:
                    if declared.iloc[i] not in declarations:
                        declarations[declared.iloc[i]] = declaring(declared.iloc[i])
                    if host.iloc[i] not in hosts:
                        hs, hn, ss, sn = (x.iloc[i] for x in lists)
                        hosts[host.iloc[i]] = np.log(_smoothed(hs, hn, _smoothed(ss, sn, corpus)))
                total = m * np.minimum(many, EFFECTIVE)[:, None]
                total += np.stack([declarations[declared.iloc[i]] for i in own])
                total += np.stack([hosts[host.iloc[i]] for i in own])
                at = total.argmax(1)
                sure = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
                language[own], probability[own] = [languages[a] for a in at], sure
                accepted[own] = (sure >= SURE) & ((m[np.arange(len(own)), at] >= -np.log(BUCKETS)) | (many < ENOUGH))
            yield pd.DataFrame({"language": language, "probability": probability, "accepted": accepted})
        give_back()
    verdict = verdicts(names["text"], names["declared"], names["host"], *[F.col(f"{got}{k}")[f] for k in "hs" for f in ("seen", "n")])
    return rows.withColumn(out, verdict).select(*docs.columns, out), out


def of_documents(docs: DataFrame) -> tuple[DataFrame, str]:
    """Documents declare ``lang``, and ``source`` is their host."""
    return identify(docs, F.col("text"), F.col("lang").cast("string"), F.col("source"))


def of_pages(pages: DataFrame) -> tuple[DataFrame, str]:
    """Pages have an address and an html element; their text is what is between tags."""
    text = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ")
    return identify(pages, text, declared_in(F.col("html")), host_of(F.col("url")))


def accept(docs: DataFrame) -> DataFrame:
    rows, name = of_documents(docs)
    return rows.where(F.col(name)["accepted"]).drop(name)
