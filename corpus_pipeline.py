"""A corpus from documents to packed batches: each stage works on all that its predecessor kept."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import bloom_dedup, fm_quality, lang_fusion, length_buckets, minhash_inverted
from tallybook.llm.common import in_fold, staged, table
from tallybook.llm.queries import SCORED


#: Rows that a task hands to Python at a time. All stages take rows one by one, and whole texts of Spark's 10,000 are held several times over.
ROWS_AT_A_TIME = 1000


def frugal(stage):
    """``stage`` in a session that hands few rows at a time to Python."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        key = "spark.sql.execution.arrow.maxRecordsPerBatch"
        if not 0 < int(spark.conf.get(key)) <= ROWS_AT_A_TIME:
            spark.conf.set(key, str(ROWS_AT_A_TIME))
        return stage(spark, docs, sf_dir)
    return run


@frugal
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified."""
    return lang_fusion.accept(docs)


@frugal
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality; the classifier learns from the labels of the documents that are left."""
    params = fm_quality.fit(docs, table(spark, sf_dir, "labels"), ~in_fold(F.col("doc_id"), 5, 0))
    return docs.where(fm_quality.score(docs, params) >= SCORED)


@frugal
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return bloom_dedup.dedup(docs)


@frugal
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash_inverted.dedup(docs, width=5)


@frugal
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in batches of their length buckets."""
    return length_buckets.pack(docs, public_tokenizers.path("word_bpe_49k.json"), added=True)


STAGES = [("language ID", language), ("quality classifier", quality), ("exact dedup", exact_dedup), ("MinHash near-dedup", near_dedup), ("packing", packing)]

#: Classifiers and near-duplicates can't be expressed in SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
