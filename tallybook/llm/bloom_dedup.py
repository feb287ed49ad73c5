"""Exact deduplication by two passes over a Bloom filter. DataFrame functions only.

Pass 1 hashes every normalised text into ``HASHES`` cells and keeps, as a packed bit table, the cells
that at least two rows fell into. Pass 2 tests each row: if any of its cells is not in the table its text
occurs once and the row passes straight through. Only the others, possibly repeated, are grouped by SHA-256.
More than ``RANGE_ROWS`` rows are dealt to ranges of the hash, each with both passes; equal texts are in one range.
A wrongly suspected row is found to be alone in its group, so results are exact.

Nulls count as the empty text, so empty and null texts are equal. Of equal texts the row with the smallest
doc_id stays; a null doc_id counts as larger than any other. Rows that repeat both text and doc_id carry
the same decision in :func:`decide`; :func:`dedup` returns one of them. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import fresh, staged

HASHES = 2
#: Cells for each row, and rows of a hash range. Each range has a filter of its own, so that filters grow with the rows while what is
#: broadcast at a time stays below 2 * CELLS_PER_ROW * RANGE_ROWS / 64 rows of 16 bytes (about 2.1 million).
CELLS_PER_ROW, RANGE_ROWS = 32, 1 << 21


def fingerprint(text: Column) -> Column:
    """SHA-256 of the text with each run of ASCII white space as one space."""
    # single spaces stay as they are, so only other runs have to match
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), "\\x20[\\x20\\x09-\\x0D]+|[\\x09-\\x0D][\\x20\\x09-\\x0D]*", " "), 256)


def _cell(sha: str, i: int, cells: int) -> Column:
    return F.pmod(F.xxhash64(F.col(sha), F.lit(i)), F.lit(cells))


def repeated_bits(prints: DataFrame, sha: str, n: int) -> tuple[DataFrame, int]:
    """Pass 1 over about ``n`` rows: the cells that two or more rows fell into, 64 to a row (word, bits), and the number of cells."""
    cells = 1024
    while cells < CELLS_PER_ROW * min(n, RANGE_ROWS):
        cells *= 2
    hit = (prints.select(F.explode(F.array(*[_cell(sha, i, cells) for i in range(HASHES)])).alias("cell"))
           .groupBy("cell").count().where("count >= 2"))
    return (hit.groupBy(F.shiftright("cell", 6).alias("word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(cell & 63 as int)))").alias("bits"))), cells


def _range(sha: str, ranges: int) -> Column:
    """A hash range of the text, apart from the hashes of the cells."""
    return F.pmod(F.xxhash64(F.col(sha), F.lit(-1)), F.lit(ranges)).cast("int")


def _ranges(n: int) -> int:
    return max(1, -(-n // RANGE_ROWS))


def suspect(rows: DataFrame, sha: str, bits: DataFrame, cells: int, flag: str) -> DataFrame:
    """Pass 2: ``rows`` with the flag whether all their cells are in the table (broadcast, see RANGE_ROWS)."""
    cols, found = rows.columns, F.lit(True)
    for i in range(HASHES):
        b = bits.select(F.col("word").alias(f"{flag}w{i}"), F.col("bits").alias(f"{flag}b{i}"))
        cell = _cell(sha, i, cells)
        rows = rows.join(F.broadcast(b), F.shiftright(cell, 6) == F.col(f"{flag}w{i}"), "left")
        found &= F.coalesce(F.getbit(F.col(f"{flag}b{i}"), cell.bitwiseAND(63)) == 1, F.lit(False))
    return rows.select(*cols, found.alias(flag))


def marked(rows: DataFrame, prints: DataFrame, sha: str, flag: str) -> DataFrame:
    """``rows`` with the flag whether their text, of hash ``sha``, may be repeated among ``prints`` (staged hashes)."""
    n = prints.count()
    ranges, parts = _ranges(n), []
    for r in range(ranges):
        def own(df: DataFrame) -> DataFrame:
            return df.where(_range(sha, ranges) == r) if ranges > 1 else df  # noqa: B023
        bits, cells = repeated_bits(own(prints.select(sha)), sha, -(-n // ranges))
        parts.append(suspect(own(rows), sha, staged(bits, "bits"), cells, flag))
    return reduce(DataFrame.unionByName, parts)


def decide(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    prints = staged(docs.select("doc_id", fingerprint(F.col("text")).alias("text_sha256")), "prints")
    rows = marked(prints, prints, "text_sha256", "maybe")
    once = rows.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    again = rows.where("maybe").drop("maybe")
    # written, so that both sides of the join are plain exchanges and a hot text can be split
    groups = staged(again.groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    return once.unionByName(again.join(groups, "text_sha256").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts; all columns are carried along. Copies are
    folded by a partial aggregation before they are shuffled."""
    sha, flag = fresh(docs, "_sha"), fresh(docs, "_maybe")
    prints = staged(docs.select(fingerprint(F.col("text")).alias(sha)), "prints")
    rows = marked(docs.withColumn(sha, fingerprint(F.col("text"))), prints, sha, flag)
    least = F.min_by(F.struct(*docs.columns), F.struct(F.col("doc_id").isNull(), F.col("doc_id")))
    again = rows.where(flag).groupBy(sha).agg(least.alias(flag)).select(f"{flag}.*")
    return rows.where(~F.col(flag)).select(*docs.columns).unionByName(again)
