"""Large tables are joined in slices: the same rows as in one piece, and no shuffle files of an earlier step on disk."""

import re
import time
from collections import Counter
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.catalog import SPARK
from tallybook.plans import purchase, sales
from tallybook.sources import stages
from tallybook.sources.lift import lift
from tallybook.sources.stages import StageStore

SF = "/root/testdata/sf0.001"


@pytest.fixture
def sliced(monkeypatch):
    monkeypatch.setattr(stages, "SLICED_ROWS", 0)


def rows(df):
    return Counter(map(str, df.collect()))


@pytest.fixture(scope="module")
def odd(spark):
    """The lifted tables with a hot invoice, lines that come twice (once without the line they credit), lines without ids or
    invoice, headers that come twice, and costs of the id that PPM and customer-grouped lines share."""
    m = lift(spark, SF)
    bi = m.base_invoice.where("not is_draft and not passed_to_accounts")
    hot = bi.join(m.invoice.select("unique_id"), "unique_id").agg(F.min("unique_id")).first()[0]

    def some(n, *key):
        return F.pmod(F.xxhash64(*key), F.lit(n)) == 0

    def lines(df, guid, credited=None, own=()):
        df = df.withColumn(guid, F.when(some(4, "unique_id"), F.lit(hot)).when(~some(40, "unique_id", guid), F.col(guid)).cast(df.schema[guid].dataType))
        twice = df.where(some(7, "unique_id"))
        if credited:
            twice = twice.unionByName(df.where(F.col(credited).isNotNull() & some(3, "unique_id")).withColumn(credited, F.lit(None).cast("string")))
        df = df.unionByName(twice)
        for c in own:
            df = df.withColumn(c, F.when(~some(31, c), F.col(c)))
        return df
    shared = m.cost.where("cost_type_id = 5").limit(3).withColumn("invoice_line_id", F.lit(""))
    qshared = m.qcost.limit(2).withColumn("invoice_line_id", F.lit(""))
    return replace(
        m, base_invoice=m.base_invoice.unionByName(m.base_invoice.where(some(9, "unique_id"))),
        invdets=lines(m.invdets, "invoice_guid", "credited_invoice_line_id", ("unique_id", "auto_id")), ppm_lines=lines(m.ppm_lines, "invoice_id"),
        cg_lines=lines(m.cg_lines, "invoice_guid", "credited_invoice_line_guid", ("unique_id",)),
        supplier_invoice_lines=lines(m.supplier_invoice_lines, "supplier_invoice_id", None, ("unique_id",)),
        subcontractor_invoice_lines=lines(m.subcontractor_invoice_lines, "subcontractor_invoice_id", None, ("unique_id",)),
        cost=m.cost.unionByName(shared).unionByName(m.cost.where(some(5, "invoice_line_id"))), qcost=m.qcost.unionByName(qshared)).check()


@pytest.mark.parametrize("report", [sales.rounded_lines_with_credits, sales.sales_export, purchase.purchase_export])
def test_slices_give_the_same_rows(spark, odd, sliced, report):
    want = rows(report(odd))
    with StageStore(spark) as store:
        assert rows(report(odd, store=store)) == want and sum(want.values()) > 1000


@pytest.mark.parametrize("key, sorts", [("bz_rounded_lines", 0), ("rp_sales", 1), ("rp_purchase", 1)])
def test_what_is_left_of_a_sliced_query_shuffles_only_to_sort(spark, sliced, key, sorts):
    plan = SPARK[key](lift(spark, SF))._jdf.queryExecution().executedPlan().toString()
    # the lift makes its tax codes from the lines
    assert set(re.findall(r"Exchange hashpartitioning\((\w+)#", plan)) <= {"tax_code_id"} and plan.count("Exchange rangepartitioning") == sorts


def test_shuffle_files_go_when_a_stage_is_written(spark):
    dirs = [Path(str(d)) for d in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()]

    def files():
        return {str(f) for d in dirs for f in d.rglob("shuffle_*.data")}
    before, old = files(), spark.conf.get(stages._CLEAN)
    df = spark.range(10_000).groupBy((F.col("id") % 999).alias("k")).agg(F.sum("id").alias("v"))
    with StageStore(spark) as store:
        got = store.stage("sums", df)
        until = time.time() + 30
        while files() - before and time.time() < until:
            time.sleep(0.2)
        assert not files() - before and rows(got) == rows(df)
        assert spark.conf.get(stages._CLEAN) == old


def test_every_row_is_in_one_slice_and_slices_go(spark):
    df = spark.range(500).select(F.when(F.col("id") % 7 > 0, F.col("id")).alias("id"))
    with StageStore(spark) as store:
        parts = store.stage_slices("ids", [df.where("id < 100"), df.where("id >= 100 or id is null")], 4, stages.slice_of(4, F.col("id")))
        assert sum((rows(p) for p in parts), Counter()) == rows(df)
        assert all(p.select(stages.slice_of(4, F.col("id"))).distinct().count() == 1 for p in parts)
        store.drop("ids", 2)
        assert [(Path(store.root.removeprefix("file:")) / "ids" / f"__slice={k}").exists() for k in range(4)] == [True, True, False, True]


def test_keys_of_different_types_are_not_sliced(spark, sliced):
    a, b = spark.range(5).select("id"), spark.range(5).select(F.col("id").cast("int").alias("id"))
    assert stages.slices_for(a, keys=[[(a, "id"), (a, "id")]]) == stages.SLICES and stages.slices_for(a, keys=[[(a, "id"), (b, "id")]]) == 1
