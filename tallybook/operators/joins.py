"""Join operators.

Lookups to small dimensions are plain left joins: adaptive execution turns
them into broadcast joins once the real (filtered) size is known, and keeps a
shuffle join when a dimension is large. No broadcast hint is given on tables
whose size nothing bounds. The tax codes get one: there are as many as VAT rates,
and a shuffle by them would leave all lines to a handful of tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.operators.skew import tasks_for


def null_columns(df: DataFrame, like: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Add every column of ``like`` (except ``skip``) to ``df`` as a typed NULL."""
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name)
                            for f in like.schema.fields if f.name not in skip])


def left_join_many(one: DataFrame, many: DataFrame, on: str | Sequence[str],
                   present: DataFrame | None = None) -> DataFrame:
    """``one LEFT JOIN many USING (on)`` for a ``many`` side that may hold a hot key.

    A left outer join can only have its preserved (left) side split when a key
    is skewed, but here the rows pile up on the right. So the join is written
    as an inner join, where adaptive execution can split a skewed partition on
    either side, plus the ``one`` rows without a partner, found by an anti join
    against the *distinct* keys of ``many`` (partially aggregated before the
    shuffle, so a hot key shrinks to one row per task).

    ``present`` may give those keys from a cheaper source (e.g. the raw table
    an expensive ``many`` is derived from row for row).

    Rows of ``one`` are hashed and those of ``many`` pass by unsorted, so a task's
    memory follows its keys, not its lines. Adaptive execution merges partitions
    by compressed size, which would let the narrow anti join take millions of
    keys in a task: its number of partitions follows the number of rows.
    """
    keys = [on] if isinstance(on, str) else list(on)
    matched = one.hint("shuffle_hash").join(many, keys, "inner")
    source = (many if present is None else present).select(*keys)
    tasks = tasks_for(source)
    present = source.dropna(how="any").distinct()
    if tasks is None:
        alone = one.join(present, keys, "left_anti")
    else:  # as an outer join, since an anti join would be moved below the repartition
        present = present.withColumn("__present", F.lit(True)).repartition(tasks, *keys)
        alone = one.repartition(tasks, *keys).join(present, keys, "left").where(F.col("__present").isNull()).drop("__present")
    unmatched = null_columns(alone, many, skip=keys)
    return matched.unionByName(unmatched)


def left_join_either_key(left: DataFrame, left_key: str, right: DataFrame,
                         key_a: str, key_b: str) -> DataFrame:
    """``left LEFT JOIN right ON right.key_a = left.left_key OR right.key_b = left.left_key``.

    A disjunctive condition cannot be hashed, so Spark would fall back to a
    nested-loop join. Each right row is instead emitted once per *distinct*
    non-NULL key (``array_distinct`` keeps a row whose two keys are equal from
    matching twice) and joined with an ordinary equi-join. The result is the
    same multiset: a right row matches a left row iff one of its keys equals
    the left key, and it is emitted once per left row it matches.
    """
    return left_join_keyed(left, left_key, either_keyed(right, key_a, key_b))


EITHER_KEY = "__either_key"


def either_keyed(right: DataFrame, key_a: str, key_b: str) -> DataFrame:
    """Each row of ``right`` once per distinct non-NULL key."""
    return (right.select("*", F.explode(F.array_distinct(F.array(F.col(key_a), F.col(key_b)))).alias(EITHER_KEY))
            .where(F.col(EITHER_KEY).isNotNull()))


def left_join_keyed(left: DataFrame, left_key: str, keyed: DataFrame) -> DataFrame:
    """The join of :func:`left_join_either_key` with rows of :func:`either_keyed`, which may be staged."""
    return left.join(keyed, left[left_key] == keyed[EITHER_KEY], "left").drop(EITHER_KEY)


def explode_id_list(df: DataFrame, list_col: str, keep: Sequence[str], value: str = "value") -> DataFrame:
    """``CROSS APPLY STRING_SPLIT(list_col, ',')``: one row per list element.

    A NULL list gives no row; an empty string gives one row holding ''.
    """
    return df.select(*keep, F.explode(F.split(F.col(list_col), ",")).alias(value))


def attach_group_total(df: DataFrame, key: str, value: Column | str, name: str,
                       where: Column | None = None) -> DataFrame:
    """Each row plus the total of ``value`` over its ``key`` group.

    Written as group-then-join rather than a window: the sum is partially
    aggregated before the shuffle, whereas a window would pull a whole hot
    group into one task, sorted. (Adaptive execution doesn't split this join,
    as its right side is an aggregate: write the totals first if one key holds
    a large part of the rows.) Rows whose
    key is NULL get a NULL total (an inner join in the source drops them).
    """
    v = F.col(value) if isinstance(value, str) else value
    src = df if where is None else df.where(where)
    totals = src.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(v).alias(name))
    return df.join(totals, key, "left")


def attach_newest(df: DataFrame, keys: Sequence[str], value: str, order_by: Sequence[str],
                  name: str) -> DataFrame:
    """Each row plus ``value`` taken from the newest row of its ``keys`` group:
    ``FIRST_VALUE(value) OVER (PARTITION BY keys ORDER BY order_by DESC)``,
    ties broken by the later ``order_by`` columns, also descending.

    Written as ``max_by`` over a struct of the ordering columns — an aggregate
    that is combined partially before the shuffle — and a null-safe join back,
    so a hot group never has to sit sorted in one task as a window would.
    """
    renamed = {k: f"__g_{k}" for k in keys}
    newest = (df.groupBy(*keys)
              .agg(F.max_by(F.col(value), F.struct(*[F.col(c) for c in order_by])).alias(name))
              .select(*[F.col(k).alias(renamed[k]) for k in keys], name))
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(newest[renamed[k]])
        cond = c if cond is None else cond & c
    return df.join(newest, cond, "left").drop(*renamed.values())
