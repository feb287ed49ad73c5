"""
lifted test tables and the equivalent DuckDB SQL (the oracle).

Every Spark query returns exact decimals from the library; at this check
boundary decimal columns are cast to double (the oracle casts the same
columns), so both engines hand over identical float64 values whatever their
decimal widths.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from checks.oracle_chains import CHAINS, CUSTOMERS_SELECT, PURCHASE_SELECT, RATE_LABEL, SALES_SELECT, localised_uk, whole_number
from checks.oracle_lift import LIFT_CTES
from tallybook.functions.dates import localise, uk_date
from tallybook.functions.money import money, round2
from tallybook.functions.text import blank_fallback, labelled_percent, no_if_false, text_to_int, yes_if_true
from tallybook.functions.valuation import ledger_net, qty_times_price, supplier_line
from tallybook.operators.aggregates import sum_coalesced
from tallybook.operators.joins import attach_newest, explode_id_list, left_join_either_key
from tallybook.plans import customers, ledger, purchase, sales, settlement
from tallybook.sources.lift import lift
from tallybook.sources.model import InvoiceModel, catalog_tables, publish
from tallybook.sources.stages import StageStore

_WITH = "with " + ",\n".join(f"{name} as ({body})" for name, body in LIFT_CTES + CHAINS)
# the chains alone, for model tables registered directly as t_<table> (tests)
CHAIN_WITH = "with " + ",\n".join(f"{name} as ({body})" for name, body in CHAINS)


def decimals_to_double(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


SPARK: dict[str, Callable[[InvoiceModel], DataFrame]] = {}
ORACLE: dict[str, str] = {}
ORACLE_BODY: dict[str, str] = {}


def query(key: str, sql: str, dbl: tuple[str, ...] = ()):
    """Register a Spark builder under ``key`` with its oracle SQL; ``dbl``
    names the oracle's decimal output columns (cast to double there)."""
    def deco(fn: Callable[[InvoiceModel], DataFrame]):
        SPARK[key] = fn
        body = sql.strip()
        if dbl:
            rep = ", ".join(f'cast("{c}" as double) as "{c}"' for c in dbl)
            body = f"select * replace ({rep}) from ({body}) q"
        ORACLE_BODY[key] = body
        ORACLE[key] = f"{_WITH}\n{body}"
        return fn
    return deco


# --------------------------------------------------------------------------- #
# scans, staging, settings                                                    #
# --------------------------------------------------------------------------- #
@query("st_staged_reuse", """
select customer_auto_id, balance, ppm_balance from o_balance left join o_balance_ppm using (customer_auto_id)""",
       ("balance", "ppm_balance"))
def _st_staged_reuse(m):
    return customers.receivable_balances(m).select("customer_auto_id", "balance", "ppm_balance")


@query("sc_scalar_setting", "select unique_id, (select timezone from t_control) as timezone from t_supplier_invoice")
def _sc_scalar_setting(m):
    return m.supplier_invoice.select("unique_id", purchase.settings_timezone(m).alias("timezone"))


# --------------------------------------------------------------------------- #
# projections and predicates                                                  #
# --------------------------------------------------------------------------- #
@query("pr_project_alias", 'select id as "ID", name as "Name", contact as "Contact", '
                           'account_number as "Account Number" from t_customer')
def _pr_project_alias(m):
    c = m.customer
    return c.select(c["id"].alias("ID"), c["name"].alias("Name"), c["contact"].alias("Contact"),
                    c["account_number"].alias("Account Number"))


@query("pr_literal_tags", """
select 'S' as source, l.invoice_guid, l.qty, l.price, l.discount_amount, l.discount_percentage, tc.value as vat_rate
from t_invdets l left join t_tax_codes tc on l.tax_code_id = tc.unique_id
union all
select 'P', l.invoice_id, l.quantity, l.price_per_unit, l.discount_amount, l.discount_percentage, tc.value
from t_ppm_lines l left join t_tax_codes tc on l.tax_code_id = tc.unique_id
union all
select 'C', l.invoice_guid, l.qty, l.price, l.discount_amount, l.discount_percentage, tc.value
from t_cg_lines l left join t_tax_codes tc on l.tax_code_id = tc.unique_id""",
       ("qty", "price", "discount_amount", "discount_percentage", "vat_rate"))
def _pr_literal_tags(m):
    return settlement.tagged_lines(m)


@query("pr_filter_flag", "select unique_id, invoice_number from t_supplier_invoice where passed_to_accounts = false")
def _pr_filter_flag(m):
    return m.supplier_invoice.where(F.col("passed_to_accounts") == F.lit(False)).select("unique_id", "invoice_number")


@query("pr_filter_ne_null", "select auto_last_id, account_number from t_customer where account_number <> ''")
def _pr_filter_ne_null(m):
    return m.customer.where(F.col("account_number") != "").select("auto_last_id", "account_number")


@query("pr_filter_conj", "select unique_id, id from t_base_invoice where is_draft = false and credit_note = false")
def _pr_filter_conj(m):
    return (m.base_invoice.where((F.col("is_draft") == F.lit(False)) & (F.col("credit_note") == F.lit(False)))
            .select("unique_id", "id"))


@query("pr_in_list_null", "select line_unique_id, type_of_invoice, line_value, global_discount_line from o_sold",
       ("line_value",))
def _pr_in_list_null(m):
    return sales.rounded_sales_lines(m).select("line_unique_id", "type_of_invoice", "line_value",
                                               "global_discount_line")


# --------------------------------------------------------------------------- #
# conditional and null functions                                              #
# --------------------------------------------------------------------------- #
@query("ex_null_dispatch", "select line_unique_id, net2 as line_value from o_line_worth", ("line_value",))
def _ex_null_dispatch(m):
    s = sales.sales_line_sources(m)
    qtp = qty_times_price(F.col("qty"), F.col("price"))
    return s.select("line_unique_id",
                    ledger_net(qtp, F.col("discount_amount"), F.col("discount_percentage")).alias("line_value"))


@query("ex_case", "select unique_id, case when credit_note = false then 'SI' else 'SC' end as type "
                  "from t_base_invoice")
def _ex_case(m):
    return m.base_invoice.select("unique_id", F.when(F.col("credit_note") == F.lit(False), "SI")
                                 .otherwise("SC").alias("type"))


@query("ex_case_simple", "select line_unique_id, line_value_no_discount from o_sold", ("line_value_no_discount",))
def _ex_case_simple(m):
    return sales.rounded_sales_lines(m).select("line_unique_id", "line_value_no_discount")


@query("ex_case_no_else", "select unique_id, type, total_excluding_vat from o_bought", ("total_excluding_vat",))
def _ex_case_no_else(m):
    return purchase.supplier_line_values(m).select("unique_id", "type", "total_excluding_vat")


@query("ex_coalesce", """
select line_unique_id, qp as qtimesp, coalesce(vat_rate, 0) as vat_rate from o_line_worth""", ("qtimesp", "vat_rate"))
def _ex_coalesce(m):
    tax = m.tax_codes.select(F.col("unique_id").alias("tc_uid"), F.col("value").alias("vat_rate"))
    s = sales.sales_line_sources(m).join(tax, F.col("tax_code_id") == F.col("tc_uid"), "left")
    return s.select("line_unique_id", qty_times_price(F.col("qty"), F.col("price")).alias("qtimesp"),
                    F.coalesce(F.col("vat_rate"), F.lit(0)).alias("vat_rate"))


@query("ex_safe_ratio", """
select unique_id, value_no_discount, total_discount_value, total_discount_percent from o_sheets where book = 'every'""",
       ("value_no_discount", "total_discount_value"))
def _ex_safe_ratio(m):
    return ledger.invoice_combined(m, "left").select("unique_id", "value_no_discount", "total_discount_value",
                                                     "total_discount_percent")


@query("ex_blank_fallback", """
select j.auto_id as job_auto_id,
       case when rtrim(coalesce(s.account_number, '')) <> '' then s.account_number else c.account_number end
           as account_reference
from t_job j left join t_contract s on s.auto_id = j.site_auto_id
     left join t_customer c on c.auto_last_id = j.customer_auto_id""")
def _ex_blank_fallback(m):
    s = m.contract.select(F.col("auto_id").alias("s_auto"), F.col("account_number").alias("s_acct"))
    c = m.customer.select(F.col("auto_last_id").alias("c_auto"), F.col("account_number").alias("c_acct"))
    df = (m.job.join(s, F.col("site_auto_id") == F.col("s_auto"), "left")
          .join(c, F.col("customer_auto_id") == F.col("c_auto"), "left"))
    return df.select(F.col("auto_id").alias("job_auto_id"),
                     blank_fallback(F.col("s_acct"), F.col("c_acct")).alias("account_reference"))


@query("ex_default_code", "select line_unique_id, coalesce(nom_code, '4000') as nominal_ref from o_sold")
def _ex_default_code(m):
    return sales.rounded_sales_lines(m).select(
        "line_unique_id", F.coalesce(F.col("nom_code"), F.lit("4000")).alias("nominal_ref"))


@query("ex_yes_no", """
select id, case when impact_job_priority = true then 'Yes' else 'No' end as impact_job_priority,
       case when show_in_bo = false then 'No' else 'Yes' end as show_in_bo,
       case when show_in_portal = false then 'No' else 'Yes' end as show_in_portal,
       case when show_in_mobile = false then 'No' else 'Yes' end as show_in_mobile
from t_customer""")
def _ex_yes_no(m):
    c = m.customer
    return c.select("id", yes_if_true(c["impact_job_priority"]).alias("impact_job_priority"),
                    no_if_false(c["show_in_bo"]).alias("show_in_bo"),
                    no_if_false(c["show_in_portal"]).alias("show_in_portal"),
                    no_if_false(c["show_in_mobile"]).alias("show_in_mobile"))


@query("ex_not_flag", "select id, not inactive as active from t_customer")
def _ex_not_flag(m):
    return m.customer.select("id", (~F.col("inactive")).alias("active"))


# --------------------------------------------------------------------------- #
# joins                                                                       #
# --------------------------------------------------------------------------- #
@query("jn_inner", "select i.unique_id, i.job_auto_id, bi.credit_note from t_invoice i "
                   "join t_base_invoice bi on i.unique_id = bi.unique_id")
def _jn_inner(m):
    bi = m.base_invoice.select("unique_id", "credit_note")
    return m.invoice.join(bi, "unique_id").select("unique_id", "job_auto_id", "credit_note")


@query("jn_left", "select l.unique_id, l.tax_code_id, tc.value as vat_rate, tc.code as tax_code from t_invdets l "
                  "left join t_tax_codes tc on l.tax_code_id = tc.unique_id", ("vat_rate",))
def _jn_left(m):
    tax = m.tax_codes.select(F.col("unique_id").alias("tc_uid"), F.col("value").alias("vat_rate"),
                             F.col("code").alias("tax_code"))
    return (m.invdets.join(tax, F.col("tax_code_id") == F.col("tc_uid"), "left")
            .select("unique_id", "tax_code_id", "vat_rate", "tax_code"))


@query("jn_dim_chain", """
select c.id, ct.description as customer_type, sr.description as selling_rate, u.full_name as account_manager,
       fcl.description as fault_code_library
from t_customer c left join t_customer_types ct on ct.cust_type_id = c.cust_type_id
     left join t_selling_rates sr on sr.id = c.selling_rate_id
     left join t_users u on u.user_id = c.account_manager_id
     left join t_fault_code_library fcl on fcl.auto_id = c.fc_library_auto_id""")
def _jn_dim_chain(m):
    c = m.customer
    ct = m.customer_types.select(F.col("cust_type_id").alias("ct_id"), F.col("description").alias("customer_type"))
    sr = m.selling_rates.select(F.col("id").alias("sr_id"), F.col("description").alias("selling_rate"))
    u = m.users.select(F.col("user_id").alias("u_id"), F.col("full_name").alias("account_manager"))
    fcl = m.fault_code_library.select(F.col("auto_id").alias("f_id"), F.col("description").alias("fault_code_library"))
    return (c.join(ct, c["cust_type_id"] == ct["ct_id"], "left").join(sr, c["selling_rate_id"] == sr["sr_id"], "left")
            .join(u, c["account_manager_id"] == u["u_id"], "left")
            .join(fcl, c["fc_library_auto_id"] == fcl["f_id"], "left")
            .select("id", "customer_type", "selling_rate", "account_manager", "fault_code_library"))


@query("jn_left_on_const", """
select c.id, r.default_library, r.uplift, r.discount
from t_customer c left join (select customer_id, uplift, discount, (select description from t_sor_library y where y.id = library_id) as default_library
                             from t_sor_link where is_default) r on r.customer_id = c.auto_last_id""", ("uplift", "discount"))
def _jn_left_on_const(m):
    link = m.sor_link.where(F.col("is_default") == F.lit(True))
    lib = m.sor_library.select(F.col("id").alias("lib_id"), F.col("description").alias("default_library"))
    return (m.customer.join(link, F.col("auto_last_id") == F.col("customer_id"), "left")
            .join(lib, F.col("library_id") == F.col("lib_id"), "left")
            .select("id", "default_library", "uplift", "discount"))


@query("jn_or_keys", """
select bought.unique_id, ordered.part_number
from t_supplier_invoice_lines bought left join t_purchase_order_lines ordered
     on bought.unique_id = ordered.supplier_invoice_line_id or bought.unique_id = ordered.supplier_credit_line_id""")
def _jn_or_keys(m):
    return left_join_either_key(m.supplier_invoice_lines, "unique_id", m.purchase_order_lines,
                                "supplier_invoice_line_id", "supplier_credit_line_id").select("unique_id",
                                                                                              "part_number")


@query("jn_self_credit", """
select i.unique_id, i.credited_invoice_guid, ci.id as credit_number, ci.is_draft as credit_is_draft,
       ci.date as credit_date_raised
from t_base_invoice i left join t_base_invoice ci on i.credited_invoice_guid = ci.unique_id""")
def _jn_self_credit(m):
    ci = m.base_invoice.select(F.col("unique_id").alias("ci_uid"), F.col("id").alias("credit_number"),
                               F.col("is_draft").alias("credit_is_draft"), F.col("date").alias("credit_date_raised"))
    return (m.base_invoice.join(ci, F.col("credited_invoice_guid") == F.col("ci_uid"), "left")
            .select("unique_id", "credited_invoice_guid", "credit_number", "credit_is_draft", "credit_date_raised"))


@query("jn_self_line", "select il.unique_id, cr.unique_id as credited_line_unique_id from t_invdets il "
                       "left join t_invdets cr on cr.auto_id = il.credited_invoice_line_id")
def _jn_self_line(m):
    cr = m.invdets.select(F.col("auto_id").alias("cr_auto"), F.col("unique_id").alias("credited_line_unique_id"))
    return (m.invdets.join(cr, F.col("credited_invoice_line_id") == F.col("cr_auto"), "left")
            .select("unique_id", "credited_line_unique_id"))


@query("jn_csv_ids", f"""
select auto_last_id, value, (select description from t_jobctl where auto_id = {whole_number('value')}) as description
from o_picked where list = 'type'""")
def _jn_csv_ids(m):
    ids = explode_id_list(m.customer, "job_type_ids", ["auto_last_id"], "value")
    jct = m.jobctl.select(F.col("auto_id").alias("jct_id"), "description")
    return (ids.join(jct, text_to_int(F.col("value")) == F.col("jct_id"), "left")
            .select("auto_last_id", "value", "description"))


@query("jn_fanout", "select line_unique_id, cost_type, qcost_type from o_sold_costs")
def _jn_fanout(m):
    r = sales.rounded_sales_lines(m).select("line_unique_id", "invdet_auto_id")
    co = m.cost.select(F.col("invoice_line_id").alias("invdet_auto_id"), F.col("cost_type_id").alias("cost_type"))
    qc = m.qcost.select(F.col("invoice_line_id").alias("invdet_auto_id"), F.col("cost_type_id").alias("qcost_type"))
    return (sales.lines_with_costs(r, co, qc, sales.no_line_id(m), "line_unique_id")
            .select("line_unique_id", "cost_type", "qcost_type"))


@query("jn_quality_filter", "select i.unique_id, i.job_auto_id from t_invoice i join t_job j on i.job_auto_id = j.auto_id")
def _jn_quality_filter(m):
    j = m.job.select(F.col("auto_id").alias("j_auto"))
    return m.invoice.join(j, F.col("job_auto_id") == F.col("j_auto")).select("unique_id", "job_auto_id")


@query("ar_split_explode", "select auto_last_id, value from o_picked where list = 'type'")
def _ar_split_explode(m):
    return explode_id_list(m.customer, "job_type_ids", ["auto_last_id"], "value")


# --------------------------------------------------------------------------- #
# aggregations                                                                #
# --------------------------------------------------------------------------- #
@query("ag_sum", "select inv as invoice_guid, sum(net2) as invoice_net from o_line_worth group by inv", ("invoice_net",))
def _ag_sum(m):
    s = sales.sales_line_sources(m)
    qtp = qty_times_price(F.col("qty"), F.col("price"))
    lv = ledger_net(qtp, F.col("discount_amount"), F.col("discount_percentage"))
    return s.groupBy("invoice_guid").agg(F.sum(lv).alias("invoice_net"))


@query("ag_sum_coalesce", "select invoice_guid, sum(coalesce(amount, 0)) as amount from t_invoice_payments "
                          "group by invoice_guid", ("amount",))
def _ag_sum_coalesce(m):
    return m.invoice_payments.groupBy("invoice_guid").agg(sum_coalesced(F.col("amount")).alias("amount"))


@query("ag_coalesce_sum", "select customer_auto_id, balance from o_balance", ("balance",))
def _ag_coalesce_sum(m):
    return customers.receivable_balances(m).select("customer_auto_id", "balance")


@query("ag_conditional_sum", "select invoice_guid, type_of_invoice, excluding_vat, discount_value, including_vat "
                             "from o_grouped where book = 'whole'", ("excluding_vat", "discount_value", "including_vat"))
def _ag_conditional_sum(m):
    return ledger.invoice_grouping(m, "inner").select("invoice_guid", "type_of_invoice", "excluding_vat",
                                                      "discount_value", "including_vat")


@query("ag_sum_rounded", "select invoice_guid, type_of_invoice, vat_amount, value_no_discount from o_grouped where book = 'whole'",
       ("vat_amount", "value_no_discount"))
def _ag_sum_rounded(m):
    return ledger.invoice_grouping(m, "inner").select("invoice_guid", "type_of_invoice", "vat_amount",
                                                      "value_no_discount")


@query("ag_count", "select job_auto_id, count(*) as visit_count from t_jobeng group by job_auto_id")
def _ag_count(m):
    return sales.visit_counts(m)


@query("ag_wide_keys", "select type_of_invoice, customer_auto_id, customer_id, customer_name, site_id, site_auto_id, "
                       "site, ppm_contract_id, job_id, job_auto_id, description, user_id, invoice_type, invoice_guid, "
                       "including_vat from o_grouped where book = 'every'", ("including_vat",))
def _ag_wide_keys(m):
    return ledger.invoice_grouping(m, "left").select(*ledger.GROUP_KEYS, "including_vat")


@query("ag_string_agg", "select auto_last_id, job_categories as names from o_assigned where has_categories")
def _ag_string_agg(m):
    return customers.job_categories_assigned(m)


@query("ag_filtered", "select credited_invoice_guid, total_credit from o_credits", ("total_credit",))
def _ag_filtered(m):
    return settlement.credit_totals(settlement.invoice_gross(m))


# --------------------------------------------------------------------------- #
# sort, set operations                                                        #
# --------------------------------------------------------------------------- #
@query("or_sort_desc", "select unique_id, invoice_number from t_supplier_invoice order by invoice_number desc")
def _or_sort_desc(m):
    return m.supplier_invoice.select("unique_id", "invoice_number").orderBy(F.col("invoice_number").desc())


@query("so_union_all", """
select 'S' as type_of_invoice, invoice_guid as line_key, unique_id as line_unique_id, qty, price from t_invdets
union all select 'P', invoice_id, unique_id, quantity, price_per_unit from t_ppm_lines
union all select 'C', invoice_guid, unique_id, qty, price from t_cg_lines""", ("qty", "price"))
def _so_union_all(m):
    return ledger.ledger_line_sources(m).select("type_of_invoice", "line_key", "line_unique_id", "qty", "price")


_CTX_COLS = ("invoice_type, customer_auto_id, customer_id, customer_name, site_auto_id, site_id, site, job_id, "
             "ppm_contract_id, job_auto_id, description, user_id, type_of_invoice, invoice_guid, credit")


@query("so_union_padded", f"select {_CTX_COLS} from o_heads where found and invoice_guid is not null")
def _so_union_padded(m):
    return ledger.invoice_context(m, "inner").drop("line_key")


@query("so_union_coerce", "select line_unique_id, cost_key as invdet_auto_id, type_of_invoice from o_line_pool")
def _so_union_coerce(m):
    return sales.sales_line_sources(m).select("line_unique_id", "invdet_auto_id", "type_of_invoice")


@query("so_union_preagg", "select invoice_guid, amount from o_payments", ("amount",))
def _so_union_preagg(m):
    return settlement.payments_by_source(m)


@query("sc_catalog_names", """
select unique_id, net, vat, total_including_vat, nom_code as nominal_code,
       (select po_number from t_purchase_order y where y.unique_id = purchase_order_id) as po_number
from o_bought""", ("net", "vat", "total_including_vat"))
def _sc_catalog_names(m):
    """The purchase lines' tables read by their three-part names, through the model and in SQL text."""
    spark = m.control.sparkSession
    schema = f"spark_catalog.tallybook_{uuid.uuid4().hex[:12]}"
    names = ["supplier_invoice", "supplier_invoice_lines", "tax_codes", "nominal_codes", "purchase_order"]
    publish(m, schema, names)
    values = purchase.supplier_line_values(replace(m, **catalog_tables(spark, schema, names)))
    codes = spark.sql(f"""
        select il.unique_id, nc.code as nominal_code from {schema}.supplier_invoice_lines il
        left join {schema}.nominal_codes nc on nc.unique_id = il.nominal_code_id""")
    po = spark.table(f"{schema}.purchase_order").select(F.col("unique_id").alias("purchase_order_id"), "po_number")
    return (values.join(po, "purchase_order_id", "left").join(codes, "unique_id", "left")
            .select("unique_id", F.col("total_excluding_vat_including_discount").alias("net"), F.col("total_vat_amount").alias("vat"),
                    "total_including_vat", "po_number", "nominal_code"))


# --------------------------------------------------------------------------- #
# math                                                                        #
# --------------------------------------------------------------------------- #
@query("ma_round_half_up", "select unique_id, round(qty * price, 2) as gross from t_invdets", ("gross",))
def _ma_round_half_up(m):
    return m.invdets.select("unique_id", round2(F.col("qty") * F.col("price")).alias("gross"))


@query("ma_round_nested", """
select il.unique_id, coalesce(round(round(il.quantity * il.price_per_unit, 2)
       * (il.discount_percentage * 0.01), 2), 0) as pct_discount
from t_supplier_invoice_lines il""", ("pct_discount",))
def _ma_round_nested(m):
    il = m.supplier_invoice_lines
    v = supplier_line(F.lit(0), F.col("quantity"), F.col("price_per_unit"), F.col("discount_percentage"),
                      F.col("discount_amount"), F.col("overridden_tax_amount"), F.lit(None))
    return il.select("unique_id", v["pct_discount"].alias("pct_discount"))


@query("ma_cast_money", "select unique_id, cast(qty * price as decimal(19,4)) as gross_money from t_invdets",
       ("gross_money",))
def _ma_cast_money(m):
    return m.invdets.select("unique_id", money(F.col("qty") * F.col("price")).alias("gross_money"))


@query("ma_arith", "select line_unique_id, off2 as discount_value, vat2 as vat_value from o_line_worth", ("discount_value", "vat_value"))
def _ma_arith(m):
    return sales.sales_line_values(m).select("line_unique_id", "discount_value", "vat_value")


@query("ma_abs", "select line_unique_id, abs(line_value) as net_amount, abs(vat_value) as tax_amount from o_sold",
       ("net_amount", "tax_amount"))
def _ma_abs(m):
    r = sales.rounded_sales_lines(m)
    return r.select("line_unique_id", F.abs("line_value").alias("net_amount"), F.abs("vat_value").alias("tax_amount"))


@query("ma_discount_pct", "select line_unique_id, discount_percentage_calc from o_sold", ("discount_percentage_calc",))
def _ma_discount_pct(m):
    return sales.rounded_sales_lines(m).select("line_unique_id", "discount_percentage_calc")


# --------------------------------------------------------------------------- #
# string, date, window                                                        #
# --------------------------------------------------------------------------- #
@query("sr_concat_ws", """
select si.unique_id, concat_ws('/', j.id, po.po_number) as job_order
from t_supplier_invoice si left join t_purchase_order po on po.unique_id = si.purchase_order_id
     left join t_job j on j.auto_id = po.job_auto_id""")
def _sr_concat_ws(m):
    po = m.purchase_order.select(F.col("unique_id").alias("po_uid"), "po_number", F.col("job_auto_id").alias("po_job"))
    j = m.job.select(F.col("auto_id").alias("j_auto"), F.col("id").alias("job_id"))
    return (m.supplier_invoice.join(po, F.col("purchase_order_id") == F.col("po_uid"), "left")
            .join(j, F.col("po_job") == F.col("j_auto"), "left")
            .select("unique_id", F.concat_ws("/", F.col("job_id"), F.col("po_number")).alias("job_order")))


@query("sr_concat_number", f"""
select id, uplift_discount
from t_customer left join (select customer_id as auto_last_id, {RATE_LABEL} as uplift_discount from t_sor_link where is_default) using (auto_last_id)""")
def _sr_concat_number(m):
    link = m.sor_link.where(F.col("is_default") == F.lit(True))
    df = m.customer.join(link, F.col("auto_last_id") == F.col("customer_id"), "left")
    return df.select("id", F.when(F.col("uplift") > 0, labelled_percent("Uplift", F.col("uplift")))
                     .when(F.col("discount") > 0, labelled_percent("Discount", F.col("discount")))
                     .alias("uplift_discount"))


@query("sr_left", "select unique_id, left(description, 30) as short_description from t_supplier_invoice_lines")
def _sr_left(m):
    return m.supplier_invoice_lines.select("unique_id", F.left(F.col("description"), F.lit(30))
                                           .alias("short_description"))


@query("sr_ids_to_names", """
select auto_last_id, job_types, job_categories from o_assigned""")
def _sr_ids_to_names(m):
    jt = customers.job_types_assigned(m).withColumnRenamed("names", "job_types")
    jc = customers.job_categories_assigned(m).withColumnRenamed("names", "job_categories")
    return jt.join(jc, "auto_last_id", "left")


@query("dt_localise", "select unique_id, timezone((select timezone from t_control), timezone('UTC', date)) "
                      "as local_date from t_base_invoice")
def _dt_localise(m):
    return m.base_invoice.select("unique_id", localise(F.col("date"), purchase.settings_timezone(m))
                                 .alias("local_date"))


@query("dt_format_uk", f"select unique_id, {localised_uk('date')} as invoice_date from t_base_invoice")
def _dt_format_uk(m):
    return m.base_invoice.select("unique_id", uk_date(localise(F.col("date"), purchase.settings_timezone(m)))
                                 .alias("invoice_date"))


@query("wn_first_value", """
select s.type_of_invoice, s.line_key, s.line_unique_id,
       first_value(s.tax_code_id) over (partition by s.type_of_invoice, s.line_key
                                        order by s.created_at desc, s.line_unique_id desc) as newest_tax_code_id
from (select 'S' as type_of_invoice, invoice_guid as line_key, unique_id as line_unique_id, tax_code_id, created_at
      from t_invdets
      union all select 'P', invoice_id, unique_id, tax_code_id, created_at from t_ppm_lines
      union all select 'C', invoice_guid, unique_id, tax_code_id, created_at from t_cg_lines) s""")
def _wn_first_value(m):
    src = ledger.ledger_line_sources(m).select("type_of_invoice", "line_key", "line_unique_id", "tax_code_id",
                                               "created_at")
    return attach_newest(src, ["type_of_invoice", "line_key"], "tax_code_id", ["created_at", "line_unique_id"],
                         "newest_tax_code_id").select("type_of_invoice", "line_key", "line_unique_id",
                                                      "newest_tax_code_id")


# --------------------------------------------------------------------------- #
# business chains                                                             #
# --------------------------------------------------------------------------- #
@query("bz_exclude_drafts", "select * from o_issued")
def _bz_exclude_drafts(m):
    return settlement.non_draft_headers(m)


@query("bz_line_union_settlement", "select * exclude (line_value, vat_value, including_vat) from o_due_lines",
       ("qty", "price", "discount_amount", "discount_percentage", "vat_rate"))
def _bz_line_union_settlement(m):
    return settlement.settlement_lines(m)


@query("bz_value_rule1", "select invoice_guid, line_value, vat_value, credit from o_due_lines", ("line_value", "vat_value"))
def _bz_value_rule1(m):
    return settlement.valued_settlement_lines(m)


@query("bz_signed_gross", "select invoice_guid, including_vat from o_due_lines", ("including_vat",))
def _bz_signed_gross(m):
    return settlement.signed_gross(m)


@query("bz_invoice_gross", "select * from o_invoice_gross", ("total_including_vat",))
def _bz_invoice_gross(m):
    return settlement.invoice_gross(m)


@query("bz_credit_totals", "select * from o_credits", ("total_credit",))
def _bz_credit_totals(m):
    return settlement.credit_totals(settlement.invoice_gross(m))


@query("bz_invoice_credit_combine", "select * from o_due_sides", ("total_including_vat", "total_credit"))
def _bz_invoice_credit_combine(m):
    return settlement.invoice_credit_combine(m)


@query("bz_payment_status", "select * from o_status", ("invoice_total", "invoice_total_inc_credits", "paid"))
def _bz_payment_status(m):
    return settlement.payment_status(m)


_LC = ("invoice_type, customer_auto_id, customer_id, customer_name, site_auto_id, site_id, site, job_id, "
       "ppm_contract_id, job_auto_id, description, user_id, type_of_invoice, invoice_guid, qty, price, "
       "discount_amount, discount_percentage, tax_code_id, credit, nominal_code_id, created_at, line_unique_id, "
       "discount_line")


@query("bz_line_context", f"select {_LC} from o_entries where book = 'whole'", ("qty", "price", "discount_amount", "discount_percentage"))
def _bz_line_context(m):
    return ledger.line_context(m, "inner").select(*[c.strip() for c in _LC.split(",")])


@query("bz_discount_kind", "select type_of_invoice, invoice_guid, line_unique_id, discount_line from o_entries where book = 'every'")
def _bz_discount_kind(m):
    return ledger.line_context(m, "left").select("type_of_invoice", "invoice_guid", "line_unique_id", "discount_line")


@query("bz_tax_nominal", "select invoice_guid, line_unique_id, vat_rate, tax_code, tax_key as tax_code_id, "
                         "nominal_code, qp as qtimesp from o_entries where book = 'whole'", ("vat_rate", "qtimesp"))
def _bz_tax_nominal(m):
    return ledger.coded_lines(m, "inner").select("invoice_guid", "line_unique_id", "vat_rate", "tax_code",
                                                 "tax_code_id", "nominal_code", "qtimesp")


@query("bz_value_rule2", "select invoice_guid, line_unique_id, net as line_value, qp as line_value_no_discount "
                         "from o_entries where book = 'whole'", ("line_value", "line_value_no_discount"))
def _bz_value_rule2(m):
    return ledger.ledger_values(m, "inner").select("invoice_guid", "line_unique_id", "line_value",
                                                   F.col("qtimesp").alias("line_value_no_discount"))


@query("bz_discount_vat", "select invoice_guid, line_unique_id, saved as discount_value, vat as vat_value from o_entries where book = 'whole'",
       ("discount_value", "vat_value"))
def _bz_discount_vat(m):
    return ledger.ledger_values(m, "inner").select("invoice_guid", "line_unique_id", "discount_value", "vat_value")


@query("bz_global_discount", "select line_unique_id, wide as global_line_value from o_wide where book = 'whole'",
       ("global_line_value",))
def _bz_global_discount(m):
    return (ledger.with_global_discount(m, "inner").where(F.col("discount_line") == 2)
            .select("line_unique_id", "global_line_value"))


_GROUP_DBL = ("excluding_vat", "value_no_discount", "discount_value", "vat_amount", "including_vat", "global_discount")


@query("bz_invoice_grouping", "select * exclude (book) from o_grouped where book = 'whole'", _GROUP_DBL)
def _bz_invoice_grouping(m):
    return ledger.invoice_grouping(m, "inner")


@query("bz_invoice_combined", "select * exclude (book) from o_sheets where book = 'every'",
       ("vat_value", "invoice_value", "total_including_vat", "total_discount_value", "value_no_discount",
        "global_discount"))
def _bz_invoice_combined(m):
    return ledger.invoice_combined(m, "left")


_TOT_DBL = ("vat_value", "invoice_value", "total_including_vat", "total_discount_value", "value_no_discount",
            "global_discount")


@query("bz_invoice_totals", "select * exclude (book) from o_totals where book = 'whole'", _TOT_DBL)
def _bz_invoice_totals(m):
    return ledger.invoice_totals(m, "inner")


@query("bz_receivable", """
select a.customer_auto_id, a.balance,
       (select x.ex_ppm_balance from o_balance_ex_ppm x where x.customer_auto_id is not distinct from a.customer_auto_id) as ex_ppm_balance
from o_balance a""", ("balance", "ex_ppm_balance"))
def _bz_receivable(m):
    return customers.receivable_balances(m).select("customer_auto_id", "balance", "ex_ppm_balance")


@query("bz_receivable_ppm", "select customer_auto_id, ppm_balance from o_balance_ppm", ("ppm_balance",))
def _bz_receivable_ppm(m):
    return customers.receivable_balances(m).select("customer_auto_id", "ppm_balance")


@query("bz_customer_tags", "select level_id, tags from o_tags")
def _bz_customer_tags(m):
    return customers.customer_tags(m)


@query("bz_supplier_line", """
select unique_id, purchase_order_id, invoice_number, tax_code, vat_code_value, total_excluding_vat,
       discount_total, net as total_excluding_vat_including_discount, vat as total_vat_amount,
       total_including_vat, nom_code, type
from o_bought""", ("vat_code_value", "total_excluding_vat", "discount_total", "total_excluding_vat_including_discount",
                  "total_vat_amount", "total_including_vat"))
def _bz_supplier_line(m):
    return purchase.supplier_line_values(m)


@query("bz_subcontractor_line", "select * from o_subcontracted", ("total_excluding_vat", "vat_amount"))
def _bz_subcontractor_line(m):
    return purchase.subcontractor_line_values(m)


@query("bz_rounded_lines", """
select invoice_guid, vat_rate, tax_code, tax_code_id, nom_code, details, unit_value, qty, credit_note, is_draft, id,
       invdet_auto_id, line_value, line_value_no_discount, discount_value, discount_percentage_calc, vat_value,
       including_vat, global_discount_line, job_auto_id, type_of_invoice, line_unique_id,
       credited_line_unique_id
from o_sold""", ("vat_rate", "unit_value", "qty", "line_value", "line_value_no_discount", "discount_value",
                 "discount_percentage_calc", "vat_value", "including_vat"))
def _bz_rounded_lines(m):
    return sales.rounded_lines_with_credits(m, StageStore(m.invdets.sparkSession))


@query("rp_customers", CUSTOMERS_SELECT)
def _rp_customers(m):
    return customers.customers_report(m)


@query("rp_purchase", PURCHASE_SELECT)
def _rp_purchase(m):
    return purchase.purchase_export(m, store=StageStore(m.supplier_invoice.sparkSession))


@query("rp_sales", SALES_SELECT)
def _rp_sales(m):
    return sales.sales_export(m, StageStore(m.invdets.sparkSession))


def spark_query(key: str) -> Callable[[SparkSession, str], DataFrame]:
    build = SPARK[key]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return decimals_to_double(build(lift(spark, sf_dir)))
    run.__name__ = key
    return run
