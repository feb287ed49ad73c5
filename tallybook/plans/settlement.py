"""Settlement chain: what each sales invoice is worth, what was credited and
paid against it, and its payment status.

Stages (all lazy DataFrames):

    non_draft_headers  -> settlement_lines -> valued_settlement_lines -> signed_gross
    invoice_gross (per invoice) -> credit_totals -> invoice_credit_combine   (B7, B8 as the source
                                                                              shapes them)
    invoice_gross -> invoice_with_credits (B8 in one aggregation)
    payments_by_source -> payment_status (B9, from invoice_with_credits)

``invoice_gross`` does not join raw lines to headers: it sums every line per
invoice first, standard lines beside the others (partial aggregation before
the shuffle), and joins those sums and the "has a job" flag to one scan of the
headers. Signs come from the header's credit flag, which is one value per
invoice, so ``sum(-x) = -sum(x)`` applies.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.money import round2, signed_by_credit
from tallybook.functions.valuation import settlement_net, settlement_vat
from tallybook.operators.aggregates import sum_coalesced
from tallybook.sources.model import InvoiceModel


def non_draft_headers(m: InvoiceModel) -> DataFrame:
    """Invoice headers that are not drafts (a NULL draft flag is dropped)."""
    return (m.base_invoice.where(F.col("is_draft") == F.lit(False))
            .select("unique_id", "credit_note", "id", "credited_invoice_guid"))


def tagged_lines(m: InvoiceModel) -> DataFrame:
    """The three line tables in one shape, tagged by source ('S', 'P', 'C'),
    each with its VAT rate looked up."""
    cols = ["invoice_guid", "qty", "price", "discount_amount", "discount_percentage", "tax_code_id"]
    s = m.invdets.select(F.lit("S").alias("source"), *cols)
    p = m.ppm_lines.select(F.lit("P").alias("source"), F.col("invoice_id").alias("invoice_guid"),
                           F.col("quantity").alias("qty"), F.col("price_per_unit").alias("price"),
                           "discount_amount", "discount_percentage", "tax_code_id")
    c = m.cg_lines.select(F.lit("C").alias("source"), *cols)
    tax = m.tax_codes.select(F.col("unique_id").alias("tax_code_id"), F.col("value").alias("vat_rate"))
    return s.unionByName(p).unionByName(c).join(F.broadcast(tax), "tax_code_id", "left").drop("tax_code_id")


def _invoices_with_job(m: InvoiceModel) -> DataFrame:
    return (m.invoice.join(m.job.select(F.col("auto_id").alias("job_auto_id")), "job_auto_id")
            .select(F.col("unique_id").alias("invoice_guid")))


def _eligible_invoices(m: InvoiceModel) -> DataFrame:
    """(source, invoice_guid, credit) of every invoice whose lines are settled.

    All sources need a non-draft header; standard invoices also need their
    Invoice row and a Job (lines of a standard invoice without a job are left
    out on purpose: the source treats them as bad data).
    """
    ed = non_draft_headers(m).select(F.col("unique_id").alias("invoice_guid"),
                                     F.col("credit_note").alias("credit"))
    s = ed.join(_invoices_with_job(m), "invoice_guid").select(F.lit("S").alias("source"), "invoice_guid", "credit")
    p = ed.select(F.lit("P").alias("source"), "invoice_guid", "credit")
    c = ed.select(F.lit("C").alias("source"), "invoice_guid", "credit")
    return s.unionByName(p).unionByName(c)


def settlement_lines(m: InvoiceModel) -> DataFrame:
    """B2: every settled line with its VAT rate and its header's credit flag."""
    return (tagged_lines(m).join(_eligible_invoices(m), ["source", "invoice_guid"])
            .select("invoice_guid", "qty", "price", "discount_amount", "discount_percentage",
                    "vat_rate", "credit"))


def _rule1(df: DataFrame) -> DataFrame:
    args = [F.col("qty"), F.col("price"), F.col("discount_amount"), F.col("discount_percentage")]
    return df.select("*", settlement_net(*args).alias("line_value"),
                     settlement_vat(*args, F.col("vat_rate")).alias("vat_value"))


def valued_settlement_lines(m: InvoiceModel) -> DataFrame:
    """Line net and VAT under the settlement rule."""
    return _rule1(settlement_lines(m)).select("invoice_guid", "line_value", "vat_value", "credit")


def signed_gross(m: InvoiceModel) -> DataFrame:
    """Line gross (net + VAT), negative on a credit note."""
    v = valued_settlement_lines(m)
    return v.select("invoice_guid",
                    signed_by_credit(F.col("credit"), F.col("line_value") + F.col("vat_value"))
                    .alias("including_vat"))


def invoice_gross(m: InvoiceModel) -> DataFrame:
    """Gross per non-draft invoice; an invoice without settled lines is 0.

    Columns: unique_id, invoice_number, credited_invoice_guid,
    total_including_vat, credit_note.
    """
    # both parts of a line's gross are rounded to 2 dp, so the partial sums
    # run on integer cents (long arithmetic; an overflow raises under ANSI)
    cents = F.coalesce((round2(F.col("line_value") + F.col("vat_value")) * F.lit(100)).cast("bigint"), F.lit(0))
    standard = F.col("source") == "S"
    per_invoice = (_rule1(tagged_lines(m)).where(F.col("invoice_guid").isNotNull())
                   .groupBy(F.col("invoice_guid").alias("unique_id"))
                   .agg(F.sum(F.when(standard, cents)).alias("standard_cents"),
                        F.sum(F.when(~standard, cents)).alias("other_cents")))
    # the lines of a standard invoice count only if it has a job
    job = _invoices_with_job(m).select(F.col("invoice_guid").alias("unique_id"), F.lit(True).alias("has_job"))
    counted = (F.coalesce(F.col("other_cents"), F.lit(0))
               + F.when(F.col("has_job"), F.coalesce(F.col("standard_cents"), F.lit(0))).otherwise(F.lit(0)))
    gross = (counted.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(22,2)")
    return (non_draft_headers(m).join(per_invoice, "unique_id", "left").join(job, "unique_id", "left")
            .select("unique_id", F.col("id").alias("invoice_number"), "credited_invoice_guid",
                    F.coalesce(signed_by_credit(F.col("credit_note"), gross), F.lit(0)).alias("total_including_vat"),
                    "credit_note"))


def payments_by_source(m: InvoiceModel) -> DataFrame:
    """Paid amount per invoice and payment source; an invoice paid from two
    sources keeps two rows."""
    def agg(df: DataFrame, key: str) -> DataFrame:
        return df.groupBy(F.col(key).alias("invoice_guid")).agg(sum_coalesced(F.col("amount")).alias("amount"))
    return (agg(m.invoice_payments, "invoice_guid")
            .unionByName(agg(m.ppm_payments, "ppm_contract_invoice_id"))
            .unionByName(agg(m.cg_payments, "invoice_guid")))


def credit_totals(gross: DataFrame) -> DataFrame:
    """Total of the credit notes raised against each invoice (negative)."""
    return (gross.where(F.col("credit_note") == F.lit(True))
            .groupBy("credited_invoice_guid")
            .agg(sum_coalesced(F.col("total_including_vat")).alias("total_credit")))


def invoice_credit_combine(m: InvoiceModel, gross: DataFrame | None = None) -> DataFrame:
    """One row carrying the credits and one carrying the invoice's own
    gross for each non-draft, non-credit invoice (summed in B9)."""
    gross = invoice_gross(m) if gross is None else gross
    cred = credit_totals(gross).withColumnRenamed("credited_invoice_guid", "cred_guid")
    a = (m.base_invoice.where((F.col("is_draft") == F.lit(False)) & (F.col("credit_note") == F.lit(False)))
         .join(cred, F.col("unique_id") == F.col("cred_guid"), "left")
         .select(F.col("id").alias("invoice_number"), F.lit(0).cast("decimal(38,4)").alias("total_including_vat"),
                 F.coalesce(F.col("total_credit"), F.lit(0)).cast("decimal(38,4)").alias("total_credit"),
                 F.col("unique_id").alias("invoice_guid")))
    b = (gross.where(F.col("credit_note") == F.lit(False))
         .select("invoice_number", F.col("total_including_vat").cast("decimal(38,4)"),
                 F.lit(0).cast("decimal(38,4)").alias("total_credit"), F.col("unique_id").alias("invoice_guid")))
    return a.unionByName(b)


def invoice_with_credits(m: InvoiceModel) -> DataFrame:
    """Per non-draft, non-credit invoice: its own gross and the total of the
    credit notes raised against it (B8 summed over its two rows).

    One aggregation over the per-invoice gross: a credit note is keyed by the
    invoice it credits, any other invoice by its own id, so each invoice meets
    its credits without a second pass over the gross. Credits pointing at an
    invoice that is a draft, a credit note or missing find no own row and are
    dropped, as the source's header-driven left join drops them.
    """
    g = invoice_gross(m)
    is_credit = F.col("credit_note") == F.lit(True)
    is_own = F.col("credit_note") == F.lit(False)
    key = F.when(is_credit, F.col("credited_invoice_guid")).when(is_own, F.col("unique_id"))
    return (g.where(key.isNotNull())
            .groupBy(key.alias("invoice_guid"))
            .agg(F.max(F.when(is_own, F.col("invoice_number"))).alias("invoice_number"),
                 F.count(F.when(is_own, F.lit(1))).alias("_own_rows"),
                 F.sum(F.when(is_own, F.col("total_including_vat"))).alias("invoice_total"),
                 F.coalesce(F.sum(F.when(is_credit, F.col("total_including_vat"))), F.lit(0)).alias("total_credit"))
            .where(F.col("_own_rows") > 0)
            .select("invoice_number", "invoice_guid", "invoice_total",
                    (F.col("invoice_total") + F.col("total_credit")).alias("invoice_total_inc_credits")))


def payment_status(m: InvoiceModel) -> DataFrame:
    """Per invoice (and payment row): totals, paid and status.

    Status is tested in order: due <= paid -> 'Paid' (so a zero-value invoice
    is Paid), paid <= 0 -> 'Unpaid', due > paid -> 'Partially Paid'. An
    invoice paid from two sources has one row per distinct paid amount.
    """
    inv = invoice_with_credits(m)
    pay = payments_by_source(m).withColumnRenamed("invoice_guid", "pay_guid")
    # grouped on the paid amount as the source does: two payment rows of the
    # same amount merge into one row that counts the invoice twice
    g = (inv.join(pay, inv["invoice_guid"] == pay["pay_guid"], "left")
         .groupBy("invoice_number", "amount", "invoice_guid")
         .agg(F.sum("invoice_total").alias("invoice_total"),
              F.sum("invoice_total_inc_credits").alias("invoice_total_inc_credits")))
    paid = F.coalesce(F.col("amount"), F.lit(0))
    due = F.col("invoice_total_inc_credits")
    status = (F.when(due <= paid, "Paid").when(paid <= 0, "Unpaid").when(due > paid, "Partially Paid"))
    return g.select(F.col("invoice_number").alias("id"), "invoice_total", "invoice_total_inc_credits",
                    paid.alias("paid"), status.alias("payment_status"), "invoice_guid")
