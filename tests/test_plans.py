"""Physical-plan checks on the report queries (sf0.001 tables)."""

from dataclasses import fields, replace

import pytest
from pyspark.sql import functions as F

from checks.catalog import SPARK
from tallybook.sources.lift import lift
from tallybook.sources.model import from_catalog, from_parquet, write_model

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "PythonUDF"]


@pytest.fixture(scope="module")
def lifted(spark):
    return lift(spark, SF)


@pytest.mark.parametrize("key", sorted(SPARK))
def test_no_nested_loop_cartesian_or_python(lifted, key):
    df = SPARK[key](lifted)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, f"{key}: {bad} in plan"


def test_sales_export_scans_each_line_table_once(spark, tmp_path):
    from tallybook.plans import sales
    from tallybook.sources.stages import StageStore
    root = str(tmp_path / "model")
    write_model(lift(spark, SF), root, files_per_table=2)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # keep file names in the plan text
    m = from_parquet(spark, root)

    def scans(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [plan.count(f"/{name}.parquet") for name in ("invdets", "ppm_lines", "cg_lines")]
    with StageStore(spark) as store:
        export = sales.sales_export(m, store)
        assert set(store.written) == {"sales-lines", "sales-partials", "sales-invoices"}
        assert scans(export) == [0, 0, 0] and scans(sales.valued_lines(m)) == [1, 1, 1]
        assert scans(store.written["sales-partials"]) == [0, 0, 0]
        got = sorted(map(str, export.collect()))
    assert got == sorted(map(str, sales.sales_export(m).collect()))


def test_customer_report_scans_the_headers_at_most_three_times(spark, tmp_path):
    from tallybook.plans import customers
    root = str(tmp_path / "model")
    write_model(lift(spark, SF), root, files_per_table=2)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # keep file names in the plan text
    plan = customers.customers_report(from_parquet(spark, root))._jdf.queryExecution().executedPlan().toString()
    assert 1 <= plan.count("/base_invoice.parquet") <= 3


def test_amounts_must_be_decimals(spark, tmp_path):
    m = lift(spark, SF)
    for wrong in (F.col("price").cast("double"), F.col("price").cast("decimal(19,6)")):
        with pytest.raises(ValueError, match="invdets.price"):
            replace(m, invdets=m.invdets.withColumn("price", wrong)).check()


def test_reading_by_catalog_name(spark):
    m = lift(spark, SF)
    for f in fields(m):
        getattr(m, f.name).limit(5).createOrReplaceGlobalTempView(f.name)
    got = from_catalog(spark, "global_temp")
    assert got.customer.count() == 5 and got.check() is got


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    from tallybook.plans import purchase
    root = str(tmp_path / "model")
    write_model(lift(spark, SF), root, files_per_table=2)
    m = from_parquet(spark, root)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # keep file names in the plan text
    plan = purchase.purchase_export(m)._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln]
    inv_scans = [ln for ln in scans if "supplier_invoice.parquet" in ln or "subcontractor_invoice.parquet" in ln]
    assert len(inv_scans) >= 2
    for ln in inv_scans:
        # the not-yet-passed filter reaches both invoice scans
        pushed = ln.split("PushedFilters: [", 1)[1].split("]", 1)[0]
        assert "passed_to_accounts" in pushed, ln
    # a lookup scan reads only the columns the export uses
    sup = [ln for ln in scans if "/supplier.parquet" in ln]
    assert sup and all("ReadSchema: struct<id:bigint,account_number:string>" in ln for ln in sup)


def test_cli_writes_the_three_reports(spark, tmp_path):
    from tallybook.cli import run
    root = str(tmp_path / "model")
    write_model(lift(spark, SF), root, files_per_table=2)
    out = str(tmp_path / "out")
    paths = run(spark, root, out, ["customers", "purchase", "sales"], fmt="csv")
    counts = {p.rsplit("/", 1)[1]: spark.read.option("header", True).csv(p).count() for p in paths}
    m = from_parquet(spark, root)
    assert counts == {"customers": m.customer.count(), "purchase": SPARK["rp_purchase"](m).count(),
                      "sales": SPARK["rp_sales"](m).count()}
    run(spark, root, out, ["customers"], fmt="parquet")
    assert "Uplift/Discount %" in spark.read.parquet(f"{out}/customers").columns


def test_text_guids_are_matched_case_insensitively(spark, tmp_path):
    # a customer-grouped invoice whose id is stored in another letter case than
    # its base header's: lower-cased at load, the two meet in the header join
    from conftest import model, table
    from tallybook.plans import ledger
    guid = "unique_id string"
    m = model(spark,
              base_invoice=table(spark, "base_invoice", [dict(unique_id="AB-01", id="INV1", credit_note=False,
                                                              is_draft=False)],
                                 "unique_id string, auto_id bigint, id string, credit_note boolean, "
                                 "credited_invoice_guid string, is_draft boolean, passed_to_accounts boolean, "
                                 "date timestamp_ntz, order_no string, account_number string, name string, "
                                 "address1 string, address2 string, address3 string, address4 string, "
                                 "postcode string, reason string"),
              invoice=table(spark, "invoice", [], f"{guid}, job_auto_id bigint, user_id bigint"),
              ppm_invoices=table(spark, "ppm_invoices", [], f"{guid}, ppm_contract_id bigint"),
              cg_invoice=table(spark, "cg_invoice", [dict(unique_id="ab-01")], f"{guid}, customer_auto_id bigint"))
    root = str(tmp_path / "guids")
    write_model(m, root, files_per_table=1)
    ctx = ledger.invoice_context(from_parquet(spark, root), "inner").collect()
    assert [(r.invoice_guid, r.type_of_invoice) for r in ctx] == [("ab-01", "C")]
    raw = ledger.invoice_context(from_parquet(spark, root, normalise_guids=False), "inner").collect()
    assert raw == []


@pytest.mark.parametrize("key, never", [
    ("bz_rounded_lines", "tax_code_id"), ("bz_subcontractor_line", "tax_code_id"), ("bz_invoice_totals", "credited_invoice_guid"),
    ("rp_purchase", "tax_code_id"), ("rp_sales", "qc_stock")])
def test_lines_are_not_shuffled_for_codes(spark, key, never):
    """Also where nothing is small enough to be broadcast unasked."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = SPARK[key](lift(spark, SF))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert f"SortMergeJoin [{never}#" not in plan
