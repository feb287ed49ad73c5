"""Operators against their plain (reference-form) equivalents."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallybook.operators.aggregates import string_agg
from tallybook.operators.joins import (attach_group_total, attach_newest, explode_id_list,
                                       left_join_either_key, left_join_many)


def same_multiset(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_either_key_join_matches_raw_or_join(spark):
    left = spark.createDataFrame([("L1",), ("L2",), ("L3",), ("L4",), (None,)], "uid string")
    right = spark.createDataFrame([("L1", "L2", "P12"),   # two different lines: matches both
                                   ("L3", "L3", "P33"),   # both keys equal: matches once
                                   (None, None, "PNN"),   # no key: matches nothing
                                   (None, "L3", "PN3")],
                                  "a string, b string, part string")
    got = left_join_either_key(left, "uid", right, "a", "b").select("uid", "part")
    raw = left.join(right, (right["a"] == left["uid"]) | (right["b"] == left["uid"]), "left").select("uid", "part")
    assert same_multiset(got, raw)
    assert sorted((r.uid or "", r.part or "") for r in got.collect()) == [
        ("", ""), ("L1", "P12"), ("L2", "P12"), ("L3", "P33"), ("L3", "PN3"), ("L4", "")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_left_join_many_equals_left_join(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], "k int, x string")
    many = spark.createDataFrame([(1, 10), (1, 11), (1, 12), (2, 20), (None, 99)], "k int, y int")
    got = left_join_many(one, many, "k").select("k", "x", "y")
    ref = one.join(many, "k", "left").select("k", "x", "y")
    assert same_multiset(got, ref)


def test_group_total_equals_window_sum(spark):
    df = spark.createDataFrame([(1, 5), (1, 7), (2, 1), (None, 3)], "k int, v int")
    got = attach_group_total(df, "k", "v", "t").select("k", "v", "t")
    w = Window.partitionBy("k")
    ref = df.select("k", "v", F.when(F.col("k").isNotNull(), F.sum("v").over(w)).alias("t"))
    assert same_multiset(got, ref)


def test_newest_equals_first_value_window(spark):
    df = spark.createDataFrame([(1, 3, "a", "x"), (1, 5, "b", "y"), (1, 5, "c", "z"), (2, 1, "d", None),
                                (None, 2, "e", "q")], "k int, t int, id string, v string")
    got = attach_newest(df, ["k"], "v", ["t", "id"], "nv").select("k", "id", "nv")
    w = Window.partitionBy("k").orderBy(F.desc("t"), F.desc("id"))
    ref = df.select("k", "id", F.first("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("nv"))
    assert same_multiset(got, ref)


def test_explode_id_list_null_empty_and_values(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "4,5")], "id int, ids string")
    got = sorted(tuple(r) for r in explode_id_list(df, "ids", ["id"]).collect())
    assert got == [(2, ""), (3, "4"), (3, "5")]


def test_string_agg_sorted_skips_nulls_all_null_is_null(spark):
    df = spark.createDataFrame([(1, "b"), (1, None), (1, "a"), (2, None)], "k int, t string")
    got = dict(df.groupBy("k").agg(string_agg("t").alias("s")).collect())
    assert got == {1: "a, b", 2: None}


def test_left_join_many_over_many_tasks(spark, monkeypatch):
    """From some number of lines on, the number of partitions follows it; the rows stay those of the plain join."""
    from tallybook.operators import skew
    one = spark.range(3000).select(F.when(F.col("id") % 50 > 0, F.col("id")).alias("k"), F.col("id").alias("x"))
    many = spark.range(4000).select((F.col("id") % 2000).alias("k"), F.col("id").alias("y"))
    want = sorted(map(str, one.join(many, "k", "left").select("k", "x", "y").collect()))
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 100)
    got = left_join_many(one, many, "k").select("k", "x", "y")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and ", 40)" in plan
    assert sorted(map(str, got.collect())) == want
