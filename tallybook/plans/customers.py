"""Customer report: profile, tags, assigned job types and categories, and
three receivable balances per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.text import labelled_percent, no_if_false, text_to_int, yes_if_true
from tallybook.operators.aggregates import string_agg
from tallybook.operators.joins import explode_id_list
from tallybook.plans.ledger import invoice_combined
from tallybook.plans.settlement import payment_status
from tallybook.sources.model import InvoiceModel


def receivable_rows(m: InvoiceModel) -> DataFrame:
    """Ledger invoice totals (customer report variant) beside their settlement
    rows: (customer_auto_id, type_of_invoice, outstanding). An invoice paid
    from two sources appears twice; drafts and credit notes have no
    settlement row and add NULL."""
    # the credited invoice that the totals (B18) add isn't needed here
    sit = invoice_combined(m, "inner").select("customer_auto_id", "unique_id", "type_of_invoice")
    ips = payment_status(m).select(
        F.col("invoice_guid"), (F.col("invoice_total_inc_credits") - F.col("paid")).alias("outstanding"))
    return (sit.join(ips, sit["unique_id"] == ips["invoice_guid"], "left")
            .select("customer_auto_id", "type_of_invoice", "outstanding"))


def receivable_balances(m: InvoiceModel) -> DataFrame:
    """B19/B20 in one aggregation pass per customer.

    balance: COALESCE(SUM(outstanding), 0) over all rows;
    ex_ppm_balance: the same over rows whose type is not 'P' — NULL when the
      customer has no such row at all (the source builds it as a separate
      grouped table and left-joins it);
    ppm_balance: balance - ex_ppm_balance (NULL when ex_ppm_balance is NULL,
      so a customer with only PPM invoices shows 0 in the report; NULL for
      the group of invoices without a customer, whose key matches nothing).
    """
    not_ppm = F.col("type_of_invoice") != "P"
    g = (receivable_rows(m).groupBy("customer_auto_id")
         .agg(F.coalesce(F.sum("outstanding"), F.lit(0)).alias("balance"),
              F.coalesce(F.sum(F.when(not_ppm, F.col("outstanding"))), F.lit(0)).alias("_ex"),
              F.count(F.when(not_ppm, F.lit(1))).alias("_n_ex")))
    ex = F.when(F.col("_n_ex") > 0, F.col("_ex"))
    ppm = F.when(F.col("customer_auto_id").isNotNull(), F.col("balance") - ex)
    return g.select("customer_auto_id", "balance", ex.alias("ex_ppm_balance"), ppm.alias("ppm_balance"))


def customer_tags(m: InvoiceModel) -> DataFrame:
    """The titles of each customer's tags (entity type 1) as one text."""
    tl = m.tag_level.where(F.col("entity_type") == 1)
    t = m.tag.select(F.col("unique_id").alias("t_uid"), "title")
    return (tl.join(t, tl["tag_id"] == t["t_uid"], "left")
            .groupBy("level_id").agg(string_agg("title").alias("tags")))


def _ids_to_names(m: InvoiceModel, list_col: str, names: DataFrame, keep_all: bool) -> DataFrame:
    ids = explode_id_list(m.customer, list_col, ["auto_last_id"], "value")
    ids = ids.select("auto_last_id", text_to_int(F.col("value")).alias("name_id"))
    nm = names.select(F.col("auto_id").alias("name_id"), F.col("description").alias("name_text"))
    linked = ids.join(nm, "name_id", "left")
    cust = m.customer.select("auto_last_id")
    rows = cust.join(linked, "auto_last_id", "left" if keep_all else "inner")
    return rows.groupBy("auto_last_id").agg(string_agg("name_text").alias("names"))


def job_types_assigned(m: InvoiceModel) -> DataFrame:
    """Job-type names per customer; customers with no list keep a NULL row."""
    return _ids_to_names(m, "job_type_ids", m.jobctl, keep_all=True)


def job_categories_assigned(m: InvoiceModel) -> DataFrame:
    """Job-category names per customer; only customers with a list."""
    return _ids_to_names(m, "job_category_ids", m.job_category, keep_all=False)


def customers_report(m: InvoiceModel) -> DataFrame:
    """All customers (37 columns, display names)."""
    c = m.customer
    ct = m.customer_types.select(F.col("cust_type_id").alias("ct_id"), F.col("description").alias("ct_desc"))
    sr = m.selling_rates.select(F.col("id").alias("sr_id"), F.col("description").alias("sr_desc"))
    u = m.users.select(F.col("user_id").alias("u_id"), F.col("full_name").alias("u_name"))
    tags = customer_tags(m)
    bal = receivable_balances(m)
    jta = job_types_assigned(m).select(F.col("auto_last_id").alias("jta_id"), F.col("names").alias("jta"))
    jca = job_categories_assigned(m).select(F.col("auto_last_id").alias("jca_id"), F.col("names").alias("jca"))
    link = (m.sor_link.where(F.col("is_default") == F.lit(True))
            .select(F.col("customer_id").alias("l_cust"), F.col("library_id").alias("l_lib"), "uplift", "discount"))
    lib = m.sor_library.select(F.col("id").alias("lib_id"), F.col("description").alias("lib_desc"))
    fcl = m.fault_code_library.select(F.col("auto_id").alias("fcl_id"), F.col("description").alias("fcl_desc"))

    df = (c.join(ct, c["cust_type_id"] == ct["ct_id"], "left")
          .join(sr, c["selling_rate_id"] == sr["sr_id"], "left")
          .join(u, c["account_manager_id"] == u["u_id"], "left")
          .join(tags, c["unique_id"] == tags["level_id"], "left")
          .join(bal, c["auto_last_id"] == bal["customer_auto_id"], "left")
          .join(jta, c["auto_last_id"] == jta["jta_id"], "left")
          .join(jca, c["auto_last_id"] == jca["jca_id"], "left")
          .join(link, c["auto_last_id"] == link["l_cust"], "left")
          .join(lib, F.col("l_lib") == lib["lib_id"], "left")
          .join(fcl, c["fc_library_auto_id"] == fcl["fcl_id"], "left"))
    z = F.lit(0)
    uplift_text = (F.when(F.col("uplift") > 0, labelled_percent("Uplift", F.col("uplift")))
                   .when(F.col("discount") > 0, labelled_percent("Discount", F.col("discount"))))
    return df.select(
        c["id"].alias("ID"), c["name"].alias("Name"), F.col("u_name").alias("Customer Account Manager"),
        c["address1"].alias("Address 1"), c["address2"].alias("Address 2"), c["address3"].alias("Address 3"),
        c["address4"].alias("Address 4"), c["postcode"].alias("Postcode"),
        c["custom_reference"].alias("Reference"), F.col("ct_desc").alias("Customer Type"),
        c["contact"].alias("Contact"), c["telephone"].alias("Telephone"),
        c["email_address"].alias("Email Address"), c["vat_number"].alias("VAT Number"),
        c["account_number"].alias("Account Number"), F.col("sr_desc").alias("Selling Rate"),
        c["warning1_used"].alias("Warning1Used"), c["warning1_comments"].alias("Warning1Comments"),
        c["warning2_used"].alias("Warning2Used"), c["warning2_comments"].alias("Warning2Comments"),
        c["warning3_used"].alias("Warning3Used"), c["warning3_comments"].alias("Warning3Comments"),
        (~c["inactive"]).alias("Active"), F.col("tags").alias("Customer Tags"),
        F.coalesce(F.col("balance"), z).alias("Total Receivable Balance"),
        F.coalesce(F.col("ex_ppm_balance"), z).alias("Standard/CG Receivable Balance"),
        F.coalesce(F.col("ppm_balance"), z).alias("PPM Receivable Balance"),
        c["job_type_category_description"].alias("Customer Job Type & Job Category - Description"),
        F.col("lib_desc").alias("Default SOR Library"), uplift_text.alias("Uplift/Discount %"),
        F.col("fcl_desc").alias("Fault Code Library"),
        yes_if_true(c["impact_job_priority"]).alias("Impact Job Priority (Yes/No)"),
        F.col("jta").alias("Job Types Assigned"), F.col("jca").alias("Job Categories Assigned"),
        no_if_false(c["show_in_bo"]).alias("Filter in Back Office (Yes/No)"),
        no_if_false(c["show_in_portal"]).alias("Filter in Customer Portal (Yes/No)"),
        no_if_false(c["show_in_mobile"]).alias("Filter in Mobile App (Yes/No)"))
