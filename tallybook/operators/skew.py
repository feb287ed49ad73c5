"""Joins in which one key may hold a large part of the rows.

The rows of a hot key are dealt out over pieces by a hash of another column, and the other side's rows of that key are copied
once for each piece. So no task gets more than its share of a hot key, whatever adaptive execution sees at run time. Which keys
are hot is either known beforehand (:func:`join_known_hot`) or measured from row counts (:func:`hot_keys`, :func:`join_hot`).
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot from this share of all rows on. At most 1 / HOT_SHARE keys are, which bounds what is broadcast.
HOT_SHARE = 1 / 1024
PIECES = 16
#: Rows that one task of a join gets at most, on average, where :func:`tasks_for` sets the number of tasks.
ROWS_PER_TASK = 500_000
_PIECE = "__piece"


def _piece(spread: Sequence[str], pieces: Column) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in spread]), pieces)


def _copies(pieces: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1))


def tasks_for(rows: DataFrame) -> int | None:
    """Number of partitions in which a join of these rows, which are counted, keeps its tasks small; None if the session's own will do."""
    n = rows.count()
    return None if n <= ROWS_PER_TASK else max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), ceil(n / ROWS_PER_TASK))


def join_known_hot(many: DataFrame, one: DataFrame, key: str, hot: Column, spread: Sequence[str], how: str = "left",
                   pieces: int | None = None) -> DataFrame:
    """``many JOIN one USING (key)`` where ``hot`` is a value that many rows of ``many`` share.

    There are PIECES pieces for each shuffle partition unless ``pieces`` says how many, as pieces meet in partitions by chance.
    ``how`` may be inner, left, left_semi or left_anti. Rows of ``many`` without a key have no partner and are dealt out too.
    """
    n = F.lit(pieces or PIECES * int(many.sparkSession.conf.get("spark.sql.shuffle.partitions"))).cast("long")
    k, single = F.col(key), F.lit(0).cast("long")
    left = many.withColumn(_PIECE, F.when(k.isNull() | (k == hot), _piece(spread, n)).otherwise(single))
    right = one.withColumn(_PIECE, _copies(F.when(k == hot, n).otherwise(F.lit(1).cast("long"))))
    return left.join(right, [key, _PIECE], how).drop(_PIECE)


def hot_keys(counts: DataFrame, key: str, n: str, share: float = HOT_SHARE) -> DataFrame:
    """(key, pieces) of the keys that hold more than ``share`` of the rows, from ``counts`` (key, n). The pieces of all
    keys together are at most 2 / share."""
    counts = counts.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(n).alias("_n"))
    limit = counts.agg((F.sum("_n") * F.lit(share)).cast("double")).scalar()
    return counts.where(F.col("_n") > limit).select(key, F.ceil(F.col("_n") / limit).cast("long").alias("_pieces"))


def join_hot(many: DataFrame, one: DataFrame, key: str, hot: DataFrame, spread: Sequence[str], how: str = "left") -> DataFrame:
    """``many JOIN one USING (key)`` with the keys of ``hot`` (from :func:`hot_keys`) in pieces. Inner, left, left_semi or left_anti."""
    n, k = F.coalesce(F.col("_pieces"), F.lit(1).cast("long")), F.col(key)
    hot = F.broadcast(hot)  # at most 1 / share rows
    rows = many.join(hot, key, "left")
    left = rows.withColumn(_PIECE, _piece(spread, F.when(k.isNull(), F.lit(1 << 20)).otherwise(n))).drop("_pieces")
    right = one.join(hot, key, "left").withColumn(_PIECE, _copies(n)).drop("_pieces")
    return left.join(right, [key, _PIECE], how).drop(_PIECE)
