"""Lift of the shared test tables (orders, lineitem, customer, ...) into the
invoice model, so every report runs over tables that grow with the scale factor.

This is test scaffolding, not part of the engine: it follows the view
specification in FIXTURES.md §3, with ranges that grow with the tables, and fills the
columns that specification leaves out with deterministic values. The same lift is
written independently in DuckDB SQL for the oracle (``checks/oracle_lift.py``).

The modulo and range expressions below decide *which* invoice is of which
sub-type, which customers lack a job, which lines carry discounts and so on;
they shape the test data and never subset it: every order and every line of
the shared tables flows into the model and through the reports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.sources.model import InvoiceModel


def _text(label: str, value):
    return F.concat(F.lit(label), value.cast("string"))


def _read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def lift(spark: SparkSession, root: str) -> InvoiceModel:
    orders = _read(spark, root, "orders")
    lineitem = _read(spark, root, "lineitem")
    customer = _read(spark, root, "customer")
    supplier = _read(spark, root, "supplier")
    part = _read(spark, root, "part")
    nation = _read(spark, root, "nation")
    region = _read(spark, root, "region")
    events = _read(spark, root, "events")

    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    base_invoice = orders.select(
        k.alias("unique_id"), k.alias("auto_id"),
        F.concat(F.lit("INV"), k.cast("string")).alias("id"),
        (k % 10 == 9).alias("credit_note"),
        F.when(k % 10 == 9, k - 8).alias("credited_invoice_guid"),
        ((F.col("o_orderstatus") == "P") & (k % 5 == 0)).alias("is_draft"),
        (F.col("o_orderpriority") == "5-LOW").alias("passed_to_accounts"),
        F.col("o_orderdate").alias("date"),
        F.when(k % 4 != 0, F.concat(F.lit("PO"), (k % 1000).cast("string"))).alias("order_no"),
        F.when(ck % 9 != 0, _text("AC", ck)).alias("account_number"), _text("Head ", ck).alias("name"),
        F.concat(k.cast("string"), F.lit(" High Street")).alias("address1"), F.col("o_orderpriority").alias("address2"),
        F.when(ck % 2 == 0, F.col("o_orderstatus")).alias("address3"), _text("Town ", ck % 40).alias("address4"),
        _text("PC", ck).alias("postcode"), F.when(k % 10 == 9, _text("reason ", F.col("o_orderstatus"))).alias("reason"))

    invoice = orders.where(k % 3 == 0).select(k.alias("unique_id"), k.alias("job_auto_id"),
                                              F.expr("o_custkey div 15").alias("user_id"))
    job = orders.where(k % 30 != 0).select(
        k.alias("auto_id"), F.concat(F.lit("J"), k.cast("string")).alias("id"),
        F.when(F.col("o_custkey") % 20 != 0, F.col("o_custkey")).alias("customer_auto_id"),
        (F.col("o_custkey") % 25).alias("site_auto_id"),
        F.col("o_orderpriority").alias("description"))
    ppm_invoices = orders.where(k % 3 == 1).select(k.alias("unique_id"), (k - k % 20).alias("ppm_contract_id"))
    ppm_contract = orders.where((k % 20 == 0) & (k % 140 != 0)).select(
        k.alias("unique_id"), F.concat(F.lit("PPM"), k.cast("string")).alias("ppm_contract_number"),
        _text("contract of ", F.col("o_orderpriority")).alias("description"), F.col("o_custkey").alias("customer_auto_id"),
        (F.col("o_custkey") % 25).alias("site_auto_id"))
    cg_invoice = orders.where(k % 3 == 2).select(
        k.alias("unique_id"),
        F.when(F.col("o_custkey") % 20 != 0, F.col("o_custkey")).alias("customer_auto_id"))

    lk, ln = F.col("l_orderkey"), F.col("l_linenumber")
    line = lineitem.select(
        F.concat_ws("-", lk.cast("string"), ln.cast("string"), F.col("l_partkey").cast("string"),
                    F.col("l_suppkey").cast("string"),
                    F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string")).alias("line_uid"),
        lk.alias("invoice_guid"), ln.alias("line_no"),
        F.when(lk % 3 == 0, "S").when(lk % 3 == 1, "P").otherwise("C").alias("kind"),
        F.col("l_quantity").cast("decimal(9,2)").alias("qty"),
        F.when(ln.isin(6, 7), F.lit(0.0)).otherwise(F.col("l_extendedprice")).cast("decimal(12,2)").alias("price"),
        F.when(ln == 3, F.lit(5.00)).when(ln == 6, F.lit(25.00)).cast("decimal(12,2)").alias("discount_amount"),
        F.when(ln.isin(2, 7), F.col("l_discount") * 100 + F.lit(0.3333)).cast("decimal(7,4)").alias("discount_percentage"),
        F.when(F.col("l_tax") > 0, F.round(F.col("l_tax") * 100).cast("int")).alias("tax_code_id"),
        F.col("l_partkey").alias("nominal_code_id"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string"), F.lit(" supplied by "),
                 F.col("l_suppkey").cast("string"), F.lit(" flag "), F.col("l_returnflag"),
                 F.col("l_linestatus")).alias("details"),
        F.col("l_shipdate").alias("created_at"),
        "l_returnflag", "l_linestatus", "l_partkey", "l_suppkey")

    invdets = line.where(F.col("kind") == "S").select(
        F.col("line_uid").alias("unique_id"), F.col("line_uid").alias("auto_id"), "invoice_guid", "qty",
        "price", "discount_amount", "discount_percentage", "tax_code_id", "nominal_code_id", "details",
        F.when(F.col("invoice_guid") % 10 == 9, F.col("line_uid")).alias("credited_invoice_line_id"),
        "created_at")
    ppm_lines = line.where(F.col("kind") == "P").select(
        F.col("line_uid").alias("unique_id"), F.col("invoice_guid").alias("invoice_id"),
        F.col("qty").alias("quantity"), F.col("price").alias("price_per_unit"), "discount_amount",
        "discount_percentage", "tax_code_id", "nominal_code_id", F.col("details").alias("description"),
        "created_at")
    cg_lines = line.where(F.col("kind") == "C").select(
        F.col("line_uid").alias("unique_id"), "invoice_guid", "qty", "price", "discount_amount",
        "discount_percentage", "tax_code_id", "nominal_code_id", "details",
        F.col("invoice_guid").alias("job_auto_id"), F.when(F.col("invoice_guid") % 10 == 9, F.col("line_uid")).alias("credited_invoice_line_guid"),
        "created_at")

    # code 3 is missing, so some lines name a tax code that isn't there
    tax_codes = (line.where(F.col("tax_code_id").isNotNull() & (F.col("tax_code_id") != 3)).select("tax_code_id").distinct()
                 .select(F.col("tax_code_id").alias("unique_id"),
                         F.concat(F.lit("T"), F.col("tax_code_id").cast("string")).alias("code"),
                         (F.col("tax_code_id") + F.when(F.col("tax_code_id") % 4 == 1, F.lit(0.555)).otherwise(0.0)).cast("decimal(6,3)").alias("value"),
                         F.concat(F.lit("Rate "), F.col("tax_code_id").cast("string")).alias("description")))
    nominal_codes = part.where(F.col("p_partkey") % 7 != 0).select(
        F.col("p_partkey").alias("unique_id"), F.col("p_brand").alias("code"))

    # four events meet three of every six invoices, over the whole range; an error is a payment without an amount
    e, group = F.col("event_id"), F.expr("event_id div 4 * 6")
    pay = events.where(F.col("event_type") != "click").select(
        (group + F.when(e % 4 == 0, 0).when(e % 4 == 1, 1).otherwise(5)).alias("invoice_guid"),
        F.when(F.col("event_type") != "error", F.col("value").cast("decimal(12,2)")).alias("amount"), F.col("event_type"))
    invoice_payments = pay.where(F.col("event_type").isin("purchase", "error")).select("invoice_guid", "amount")
    ppm_payments = pay.where(F.col("event_type") == "signup").select(
        F.col("invoice_guid").alias("ppm_contract_invoice_id"), "amount")
    cg_payments = pay.where(F.col("event_type") == "view").select("invoice_guid", "amount")
    jobeng = events.where(F.col("event_type") == "click").select((group + e % 2 * 3).alias("job_auto_id"))

    c = F.col("c_custkey")
    customer_m = customer.select(
        c.alias("auto_last_id"), c.alias("unique_id"), F.concat(F.lit("CUST"), c.cast("string")).alias("id"),
        F.col("c_name").alias("name"),
        F.concat(c.cast("string"), F.lit(" Low Road")).alias("address1"), _text("Unit ", F.col("c_nationkey")).alias("address2"),
        F.when(c % 2 == 1, F.col("c_mktsegment")).alias("address3"), _text("County ", F.col("c_nationkey")).alias("address4"),
        _text("Z", c).alias("postcode"), F.when(c % 3 != 0, _text("ref ", F.col("c_name"))).alias("custom_reference"),
        F.col("c_mktsegment").alias("contact"), _text("0", c + 1000000).alias("telephone"),
        F.concat(F.lit("c"), c.cast("string"), F.lit("@example.org")).alias("email_address"),
        F.when(c % 4 != 0, _text("VAT", c)).alias("vat_number"),
        F.when(c % 3 == 0, F.lit("")).when(c % 3 == 1, F.concat(F.lit("A"), c.cast("string"))).alias("account_number"),
        (c % 2 == 0).alias("warning1_used"), F.when(c % 2 == 0, _text("first ", F.col("c_mktsegment"))).alias("warning1_comments"),
        F.when(c % 3 != 0, c % 3 == 1).alias("warning2_used"), _text("second ", F.col("c_name")).alias("warning2_comments"),
        (F.col("c_acctbal") > 5000).alias("warning3_used"), F.when(F.col("c_acctbal") > 5000, "third").alias("warning3_comments"),
        (F.col("c_acctbal") < 0).alias("inactive"),
        F.when(c % 10 == 0, F.lit(None).cast("string")).when(c % 10 == 1, F.lit(""))
         .otherwise(F.concat_ws(",", F.col("c_nationkey").cast("string"), (c % 25).cast("string"))).alias("job_type_ids"),
        F.when(c % 8 == 0, F.lit(None).cast("string")).when(c % 8 == 1, F.lit(""))
         .otherwise(F.concat_ws(",", (c % 19).cast("string"), ((c + 5) % 23).cast("string"))).alias("job_category_ids"),
        F.col("c_mktsegment").alias("job_type_category_description"),
        F.when(c % 4 != 0, c % 4 == 1).alias("impact_job_priority"),
        F.when(c % 5 != 0, c % 5 > 2).alias("show_in_bo"),
        F.when(c % 6 != 0, c % 6 > 3).alias("show_in_portal"),
        F.when(c % 7 != 0, c % 7 > 4).alias("show_in_mobile"),
        (c % 6).alias("cust_type_id"), (c % 4).alias("selling_rate_id"),
        F.col("c_nationkey").alias("account_manager_id"), (F.col("c_nationkey") % 5).alias("fc_library_auto_id"))

    nk = F.col("n_nationkey")
    contract = nation.select(
        nk.alias("auto_id"), F.concat(F.lit("SITE"), nk.cast("string")).alias("id"), F.col("n_name").alias("site"),
        F.when(nk % 2 == 0, F.concat(F.lit("S"), nk.cast("string"))).when(nk % 3 == 0, F.lit(" ")).alias("account_number"))
    job_types = nation.where(nk.between(1, 19)).select(nk.alias("auto_id"), F.col("n_name").alias("description"))
    rk = F.col("r_regionkey")
    tag = region.select(rk.alias("unique_id"), F.col("r_name").alias("title"))
    tag_level = customer.select(c.alias("level_id"), (c % 6).alias("tag_id"), (1 + c % 2).alias("entity_type")) \
        .unionByName(customer.where(c % 3 == 0).select(c.alias("level_id"), ((c + 1) % 6).alias("tag_id"),
                                                      F.lit(1).cast("bigint").alias("entity_type")))
    customer_types = region.select(rk.alias("cust_type_id"), F.col("r_name").alias("description"))
    selling_rates = region.where(rk < 3).select(rk.alias("id"), F.concat(F.lit("Rate "), F.col("r_name")).alias("description"))
    fault_code_library = region.select(rk.alias("auto_id"), F.concat(F.lit("FCL "), F.col("r_name")).alias("description"))
    sor_library = nation.select(nk.alias("id"), F.concat(F.lit("SOR "), F.col("n_name")).alias("description"))
    sor_link = customer.select(
        c.alias("customer_id"), F.col("c_nationkey").alias("library_id"), (c % 2 == 0).alias("is_default"),
        F.when(c % 3 == 0, F.col("c_nationkey")).cast("decimal(9,2)").alias("uplift"),
        F.when(c % 3 == 1, F.col("c_nationkey")).cast("decimal(9,2)").alias("discount"))
    sk = F.col("s_suppkey")
    users = supplier.select(sk.alias("user_id"), F.col("s_name").alias("full_name"), sk.alias("engineer_id"),
                            F.col("s_name").alias("reference"))
    engineer = supplier.select(sk.alias("auto_last_id"))

    cost = line.where(F.col("l_returnflag") == "A").select(
        F.col("line_uid").alias("invoice_line_id"),
        F.when(F.col("l_linestatus") == "F", 5).otherwise(9).alias("cost_type_id"),
        F.col("l_suppkey").alias("engineer_auto_id"))
    qcost = line.where(F.col("l_returnflag").isin("A", "N")).select(
        F.col("line_uid").alias("invoice_line_id"),
        F.when(F.col("l_linestatus") == "F", 9).otherwise(5).alias("cost_type_id"),
        F.col("l_partkey").alias("schedule_of_rates_item_id"), F.col("l_partkey").alias("stock_item_id"))
    pk = F.col("p_partkey")
    sor_item = part.where(pk % 3 != 0).select(pk.alias("id"), F.concat(F.lit("SR"), pk.cast("string")).alias("code"))
    stock_part = part.where(pk % 4 != 0).select(pk.alias("stock_item_id"),
                                                F.concat(F.lit("PN"), pk.cast("string")).alias("number"))
    control = region.where(rk == 0).select(F.lit("Europe/London").alias("timezone"))

    pinv = orders.select(
        k.alias("unique_id"), (k % 2 == 0).alias("is_supplier"),
        F.when((k % 10).isin(4, 9), 1).when((k % 50).isin(8, 13), 2).otherwise(0).alias("type"),
        F.concat(F.lit("PI"), k.cast("string")).alias("invoice_number"), F.col("o_orderdate").alias("date"),
        (F.col("o_orderpriority") == "5-LOW").alias("passed_to_accounts"), k.alias("job_auto_id"),
        F.expr("o_custkey div 12").alias("party_id"), F.concat(F.lit("PON"), k.cast("string")).alias("po_number"))
    inv_cols = [F.col("unique_id"), F.col("unique_id").alias("purchase_order_id"), "invoice_number", "type",
                "date", "passed_to_accounts"]
    supplier_invoice = pinv.where("is_supplier").select(*inv_cols)
    subcontractor_invoice = pinv.where(~F.col("is_supplier")).select(*inv_cols)
    purchase_order = pinv.where("is_supplier").select("unique_id", "po_number", "job_auto_id",
                                                      F.col("party_id").alias("supplier_id"))
    subcontractor_po = pinv.where(~F.col("is_supplier")).select("unique_id", "po_number", "job_auto_id",
                                                               F.col("party_id").alias("subcontractor_id"))
    supplier_m = supplier.select(sk.alias("id"), F.concat(F.lit("SUP"), sk.cast("string")).alias("account_number"))
    subcontractor = supplier.where(sk % 2 == 0).select(
        sk.alias("id"), F.concat(F.lit("SUB"), sk.cast("string")).alias("account_number"))

    ln2 = F.col("line_no")
    pline = line.select(
        "line_uid", F.col("invoice_guid").alias("invoice_id"), F.col("qty").alias("quantity"),
        F.col("price").alias("price_per_unit"),
        F.when(ln2 == 2, F.col("discount_percentage")).alias("discount_percentage"),
        F.when(ln2 == 3, F.col("discount_amount")).alias("discount_amount"),
        F.when(ln2 == 5, F.lit(3.33)).cast("decimal(12,2)").alias("overridden_tax_amount"),
        "tax_code_id", "nominal_code_id", F.col("details").alias("description"))
    supplier_invoice_lines = pline.where(F.col("invoice_id") % 2 == 0).select(
        F.col("line_uid").alias("unique_id"), F.col("invoice_id").alias("supplier_invoice_id"), "quantity",
        "price_per_unit", "discount_percentage", "discount_amount", "overridden_tax_amount", "tax_code_id",
        "nominal_code_id", "description")
    subcontractor_invoice_lines = pline.where(F.col("invoice_id") % 2 == 1).select(
        F.col("line_uid").alias("unique_id"), F.col("invoice_id").alias("subcontractor_invoice_id"), "quantity",
        "price_per_unit", "tax_code_id", "nominal_code_id", "description")
    po_line = line.select(
        F.when(F.col("l_returnflag") != "R", F.col("line_uid")).alias("invoice_line_id"),
        F.when(F.col("l_linestatus") == "F", F.col("line_uid")).alias("credit_line_id"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("part_number"))
    purchase_order_lines = po_line.select(F.col("invoice_line_id").alias("supplier_invoice_line_id"),
                                          F.col("credit_line_id").alias("supplier_credit_line_id"), "part_number")
    subcontractor_po_lines = po_line.select("invoice_line_id", "credit_line_id")

    return InvoiceModel(
        base_invoice=base_invoice, invoice=invoice, invdets=invdets, ppm_invoices=ppm_invoices,
        ppm_lines=ppm_lines, ppm_contract=ppm_contract, cg_invoice=cg_invoice, cg_lines=cg_lines,
        invoice_payments=invoice_payments, ppm_payments=ppm_payments, cg_payments=cg_payments,
        tax_codes=tax_codes, nominal_codes=nominal_codes, job=job, customer=customer_m, contract=contract,
        tag_level=tag_level, tag=tag, jobctl=job_types, job_category=job_types, customer_types=customer_types,
        selling_rates=selling_rates, users=users, sor_link=sor_link, sor_library=sor_library,
        fault_code_library=fault_code_library, control=control, supplier_invoice=supplier_invoice,
        supplier_invoice_lines=supplier_invoice_lines, purchase_order_lines=purchase_order_lines,
        purchase_order=purchase_order, supplier=supplier_m, subcontractor_invoice=subcontractor_invoice,
        subcontractor_invoice_lines=subcontractor_invoice_lines, subcontractor_po_lines=subcontractor_po_lines,
        subcontractor_po=subcontractor_po, subcontractor=subcontractor, jobeng=jobeng, cost=cost, qcost=qcost,
        sor_item=sor_item, stock_part=stock_part, engineer=engineer,
    ).check()
