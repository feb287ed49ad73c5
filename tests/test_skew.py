"""Hot keys: no task gets much more than the others, without adaptive execution; results stay those of the plain join."""

import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallybook.operators.skew import hot_keys, join_hot, join_known_hot
from tallybook.plans import sales
from tallybook.sources.lift import lift
from tallybook.sources.stages import StageStore

SF = "/root/testdata/sf0.001"


@pytest.fixture
def fixed(spark):
    """Joins as planned: shuffled, and not changed at run time."""
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def loads(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]


def rows(df):
    return Counter(map(tuple, df.collect()))


def lines(spark, n=30000):
    """Two thirds of the lines on id 0, some without an id."""
    return spark.range(n).select(F.col("id").alias("line"), F.when(F.col("id") % 3 < 2, F.lit(0)).when(F.col("id") % 100 == 2, None)
                                 .otherwise(F.col("id")).cast("long").alias("k"))


def test_known_hot_key_is_dealt_out(fixed):
    many, one = lines(fixed), fixed.range(2000).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    got = join_known_hot(many, one, "k", F.lit(0), ["line"])
    assert rows(got.select("line", "k", "v")) == rows(many.join(one, "k", "left").select("line", "k", "v"))
    assert max(loads(many.join(one, "k", "left"))) > 5 * statistics.median(loads(many.join(one, "k", "left")))
    assert max(loads(got)) <= 2 * statistics.median(loads(got))


def test_costs_of_the_shared_line_id(fixed):
    """Both costs and quantity costs of the shared id; ids that only one side has; null ids."""
    co = fixed.createDataFrame([(0, 1, 7), (0, 2, 8), (5, 3, 9), (None, 4, 1), (8, 1, 1), (8, 1, 1)], "invdet_auto_id long, co_type int, engineer_auto_id long")
    qc = fixed.createDataFrame([(0, 9, 1), (11, 5, 2), (None, 5, 3), (8, 5, 2), (0, 5, 5)], "invdet_auto_id long, qc_type int, qc_stock long")
    many = lines(fixed).withColumnRenamed("k", "invdet_auto_id")
    got = sales.lines_with_costs(many, co, qc, F.lit(0), "line")
    want = many.join(co, "invdet_auto_id", "left").join(qc, "invdet_auto_id", "left")
    columns = ["line", "invdet_auto_id", "co_type", "engineer_auto_id", "qc_type", "qc_stock"]
    assert rows(got.select(*columns)) == rows(want.select(*columns))
    assert max(loads(got)) <= 2 * statistics.median(loads(got))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_measured_hot_keys_are_dealt_out(fixed, how):
    many = lines(fixed).withColumn("k", F.when(F.col("line") % 9 == 1, F.lit(1)).otherwise(F.col("k")))
    one = fixed.range(2000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    hot = hot_keys(many.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "k", "n")
    assert {r["k"] for r in hot.collect()} == {0, 1} and hot.agg(F.sum("_pieces")).first()[0] <= 2048
    got = join_hot(many, one, "k", hot, ["line"], how)
    assert rows(got.select("line", "k", "v")) == rows(many.join(one, "k", how).select("line", "k", "v"))
    assert max(loads(got)) <= 2 * statistics.median(loads(got))


def test_no_rows_no_hot_keys(fixed):
    many, one = lines(fixed, 0), fixed.range(3).select(F.col("id").alias("k"))
    hot = hot_keys(many.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "k", "n")
    assert join_hot(many, one, "k", hot, ["line"]).count() == 0
    assert join_known_hot(many, one, "k", F.lit(0), ["line"]).count() == 0


@pytest.fixture(scope="module")
def skewed(spark):
    """The lifted tables with a third of the standard lines on one open invoice."""
    from dataclasses import replace

    m = lift(spark, SF)
    hot = m.base_invoice.where("not is_draft and not passed_to_accounts and not credit_note").join(m.invoice.select("unique_id"), "unique_id").agg(F.min("unique_id")).first()[0]
    guid = F.when(F.pmod(F.xxhash64("unique_id"), F.lit(3)) == 0, F.lit(hot)).otherwise(F.col("invoice_guid"))
    return replace(m, invdets=m.invdets.withColumn("invoice_guid", guid.cast(m.invdets.schema["invoice_guid"].dataType)))


def test_lines_of_a_hot_open_invoice_are_dealt_out(fixed, skewed):
    values = sales.sales_line_values(skewed, heads=skewed.base_invoice.where("not is_draft").select(F.col("unique_id").alias("invoice_guid")))
    assert max(loads(values)) <= 2 * statistics.median(loads(values))


def test_staged_export_is_the_lazy_one_and_its_stages_go(spark, skewed):
    with StageStore(spark) as store:
        got = rows(sales.sales_export(skewed, store))
        again = store.stage("sales-lines", spark.range(1))
        assert again is store.written["sales-lines"] and "line_value" in again.columns  # a name is written once
    assert got == rows(sales.sales_export(skewed)) and sum(got.values()) > 1000
    path = spark._jvm.org.apache.hadoop.fs.Path(store.root)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
