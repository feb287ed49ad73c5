"""Ledger totals chain, shared by the customer report and the sales export.

    invoice_context (per invoice) ⟕ lines -> line_context      (B10, B11, line level)
    -> coded_lines (tax / nominal codes, qty x price)          (B12, line level)
    -> ledger_values (net, discount, VAT)                      (B13, B14, line level)
    -> with_global_discount (invoice-wide percentage lines)    (B15, line level, via invoice_nets)

    line_partials (per invoice, map-side) + invoice_context
    -> invoice_grouping (five rounded sums per invoice)        (B16, no line-level shuffle)
    -> invoice_combined (header, discount %)                   (B17)
    -> invoice_totals (credited invoice, final rounding)       (B18)

The line-level stages serve the line-level outputs; the invoice totals are
built from per-invoice partial sums so the line table is never shuffled.

``how`` selects the join type of the header joins: ``"inner"`` for the
customer report, ``"left"`` for the sales export (which keeps invoice rows
that have no header or no job).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tallybook.functions.money import (AMOUNT, MONEY, money, money_ratio, round2,
                                       signed_by_credit)
from tallybook.functions.valuation import (discount_kind, invoice_wide_discount, ledger_net,
                                           ledger_vat, qty_times_price)
from tallybook.operators.joins import left_join_many
from tallybook.sources.model import InvoiceModel

GROUP_KEYS = ["type_of_invoice", "customer_auto_id", "customer_id", "customer_name", "site_id",
              "site_auto_id", "site", "ppm_contract_id", "job_id", "job_auto_id", "description",
              "user_id", "invoice_type", "invoice_guid"]


def _null_like(df: DataFrame, col: str, alias: str) -> Column:
    """A NULL typed like ``df.col`` (padding for a sub-type that lacks it)."""
    return F.lit(None).cast(df.schema[col].dataType).alias(alias)


def _check_how(how: str) -> str:
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    return how


def invoice_context(m: InvoiceModel, how: str, headers: str | None = None) -> DataFrame:
    """One row per invoice (and sub-type) with customer, site and job context.

    ``line_key`` is the sub-type header's own id, used to find its lines;
    ``invoice_guid`` is the base header's id (NULL without a header when
    ``how='left'``).

    The three sub-type headers are brought to one shape first (each with its
    own job or contract lookup), so the base header, customer and site are
    each joined once for all of them. ``headers`` may set the join type of the
    base header alone.
    """
    how = _check_how(how)
    job = m.job.select(F.col("auto_id").alias("j_auto"), F.col("id").alias("j_id"),
                       F.col("customer_auto_id").alias("j_cust"), F.col("site_auto_id").alias("j_site"),
                       F.col("description").alias("j_desc"))
    s = (m.invoice.join(job, F.col("job_auto_id") == F.col("j_auto"), how)
         .select(F.lit(0).alias("invoice_type"), F.lit("S").alias("type_of_invoice"),
                 F.col("unique_id").alias("line_key"), F.col("j_cust").alias("cust_key"),
                 F.col("j_site").alias("site_key"), F.col("j_id").alias("job_id"),
                 _null_like(m.ppm_contract, "unique_id", "ppm_contract_id"), F.col("j_auto").alias("job_auto_id"),
                 F.col("j_desc").alias("description"), "user_id"))
    pc = m.ppm_contract.select(F.col("unique_id").alias("p_uid"), F.col("description").alias("p_desc"),
                               F.col("customer_auto_id").alias("p_cust"), F.col("site_auto_id").alias("p_site"))
    p = (m.ppm_invoices.join(pc, F.col("ppm_contract_id") == F.col("p_uid"), "left")
         .select(F.lit(1).alias("invoice_type"), F.lit("P").alias("type_of_invoice"),
                 F.col("unique_id").alias("line_key"), F.col("p_cust").alias("cust_key"),
                 F.col("p_site").alias("site_key"), _null_like(m.job, "id", "job_id"),
                 F.col("p_uid").alias("ppm_contract_id"), _null_like(m.job, "auto_id", "job_auto_id"),
                 F.col("p_desc").alias("description"), _null_like(m.invoice, "user_id", "user_id")))
    c = m.cg_invoice.select(
        F.lit(2).alias("invoice_type"), F.lit("C").alias("type_of_invoice"), F.col("unique_id").alias("line_key"),
        F.col("customer_auto_id").alias("cust_key"), _null_like(m.job, "site_auto_id", "site_key"),
        _null_like(m.job, "id", "job_id"), _null_like(m.ppm_contract, "unique_id", "ppm_contract_id"),
        _null_like(m.job, "auto_id", "job_auto_id"), _null_like(m.job, "description", "description"),
        _null_like(m.invoice, "user_id", "user_id"))
    heads = s.unionByName(p).unionByName(c)

    bi = m.base_invoice.select(F.col("unique_id").alias("bi_guid"), F.col("credit_note").alias("credit"))
    cust = m.customer.select(F.col("auto_last_id").alias("c_auto"), F.col("id").alias("customer_id"),
                             F.col("name").alias("customer_name"))
    site = m.contract.select(F.col("auto_id").alias("s_auto"), F.col("id").alias("site_id"), "site")
    # the base header comes last: its id is the invoice's, on which the callers go on without another shuffle
    df = (heads.join(cust, F.col("cust_key") == F.col("c_auto"), "left")
          .join(site, F.col("site_key") == F.col("s_auto"), "left")
          .join(bi, F.col("line_key") == F.col("bi_guid"), headers or how))
    return df.select("invoice_type", F.col("c_auto").alias("customer_auto_id"), "customer_id", "customer_name",
                     F.col("s_auto").alias("site_auto_id"), "site_id", "site", "job_id", "ppm_contract_id",
                     "job_auto_id", "description", "user_id", "type_of_invoice",
                     F.col("bi_guid").alias("invoice_guid"), "credit", "line_key")


def ledger_line_sources(m: InvoiceModel) -> DataFrame:
    """The three line tables in one shape, keyed by (type_of_invoice, line_key)."""
    cols = ["qty", "price", "discount_amount", "discount_percentage", "tax_code_id", "nominal_code_id",
            "created_at", F.col("unique_id").alias("line_unique_id")]
    s = m.invdets.select(F.lit("S").alias("type_of_invoice"), F.col("invoice_guid").alias("line_key"), *cols)
    p = m.ppm_lines.select(F.lit("P").alias("type_of_invoice"), F.col("invoice_id").alias("line_key"),
                           F.col("quantity").alias("qty"), F.col("price_per_unit").alias("price"),
                           *cols[2:])
    c = m.cg_lines.select(F.lit("C").alias("type_of_invoice"), F.col("invoice_guid").alias("line_key"), *cols)
    return s.unionByName(p).unionByName(c)


def line_context(m: InvoiceModel, how: str) -> DataFrame:
    """Every invoice with each of its lines (an invoice without lines
    keeps one row with NULL line columns) and the discount-line kind.

    The kind is computed for standard lines only; other sub-types carry NULL.
    """
    ctx = invoice_context(m, how)
    rows = left_join_many(ctx, ledger_line_sources(m), ["type_of_invoice", "line_key"])
    kind = F.when(F.col("type_of_invoice") == "S",
                  discount_kind(F.col("price"), F.col("discount_amount"), F.col("discount_percentage")))
    return rows.select("*", kind.alias("discount_line"))


def coded_lines(m: InvoiceModel, how: str) -> DataFrame:
    """VAT rate, tax code and nominal code per line, and qty x price."""
    tax = m.tax_codes.select(F.col("unique_id").alias("tc_uid"), F.col("value").alias("vat_rate"),
                             F.col("code").alias("tax_code"))
    nom = m.nominal_codes.select(F.col("unique_id").alias("nc_uid"), F.col("code").alias("nominal_code"))
    df = (line_context(m, how)
          .join(F.broadcast(tax), F.col("tax_code_id") == F.col("tc_uid"), "left")
          .join(nom, F.col("nominal_code_id") == F.col("nc_uid"), "left"))
    return df.select(*[c for c in df.columns if c not in ("tc_uid", "nc_uid", "tax_code_id")],
                     F.col("tc_uid").alias("tax_code_id"),
                     qty_times_price(F.col("qty"), F.col("price")).alias("qtimesp"))


def ledger_values(m: InvoiceModel, how: str) -> DataFrame:
    """Rounded net, undiscounted value, discount and unrounded VAT."""
    df = coded_lines(m, how)
    lv = ledger_net(F.col("qtimesp"), F.col("discount_amount"), F.col("discount_percentage"))
    df = df.select("*", lv.alias("line_value"))
    return df.select("*", (F.col("qtimesp") - F.col("line_value")).alias("discount_value"),
                     ledger_vat(F.col("line_value"), F.col("vat_rate")).alias("vat_value"))


def invoice_nets(m: InvoiceModel, how: str) -> DataFrame:
    """Summed line net per base invoice id over all its context rows (the
    total an invoice-wide percentage applies to). Built from the per-invoice
    partial sums and the header ids alone: a narrow pre-aggregated scan of the
    lines, without the look-ups of the context and a second pass over the
    enriched line rows."""
    keys = ["type_of_invoice", "line_key"]
    return (invoice_ids(m, how)
            .join(line_partials(m).select(*keys, "p_net"), keys, "left")
            .groupBy(F.col("line_key").alias("invoice_guid")).agg(F.sum("p_net").alias("invoice_net")))


def invoice_ids(m: InvoiceModel, how: str) -> DataFrame:
    """(type_of_invoice, line_key) of each row of the context that has a base header."""
    s = m.invoice.select(F.lit("S").alias("type_of_invoice"), F.col("unique_id").alias("line_key"), "job_auto_id")
    if _check_how(how) == "inner":
        s = s.join(m.job.select(F.col("auto_id").alias("j_auto")), F.col("job_auto_id") == F.col("j_auto"), "left_semi")
    p = m.ppm_invoices.select(F.lit("P").alias("type_of_invoice"), F.col("unique_id").alias("line_key"))
    c = m.cg_invoice.select(F.lit("C").alias("type_of_invoice"), F.col("unique_id").alias("line_key"))
    heads = s.drop("job_auto_id").unionByName(p).unionByName(c)
    return heads.join(m.base_invoice.select(F.col("unique_id").alias("line_key")), "line_key", "left_semi")


def with_global_discount(m: InvoiceModel, how: str) -> DataFrame:
    """Amount of each invoice-wide percentage line (kind 2): the invoice's
    summed net times the percentage entered on the line. Other lines: NULL."""
    df = with_invoice_net(ledger_values(m, how), invoice_nets(m, how))
    amt = F.when(F.col("discount_line") == 2,
                 invoice_wide_discount(F.col("invoice_net"), F.col("discount_percentage")))
    return df.select("*", amt.alias("global_line_value"))


def with_invoice_net(lines: DataFrame, nets: DataFrame) -> DataFrame:
    """``lines`` with ``invoice_net`` beside those of kind 2, the only ones that
    need it. The others have no key and are dealt out by their line id, so an
    invoice with very many lines doesn't meet in one task."""
    is2 = F.coalesce(F.col("discount_line") == 2, F.lit(False))
    nets = nets.select(F.col("invoice_guid").alias("_net_guid"), F.lit(0).cast("long").alias("_net_spread"), "invoice_net")
    keyed = lines.select("*", F.when(is2, F.col("invoice_guid")).alias("_guid"),
                         F.when(is2, F.lit(0).cast("long")).otherwise(F.xxhash64("line_unique_id")).alias("_spread"))
    return (keyed.join(nets, (F.col("_guid") == F.col("_net_guid")) & (F.col("_spread") == F.col("_net_spread")), "left")
            .drop("_guid", "_spread", "_net_guid", "_net_spread"))


def _rounded(c: Column) -> Column:
    return money(round2(c))


def _cents(c: Column) -> Column:
    """An amount rounded to 2 dp as an integer number of cents."""
    return (round2(c) * F.lit(100)).cast("bigint")


def _from_cents(c: Column) -> Column:
    return (c.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(DecimalType(22, 2))


def _units4(c: Column) -> Column:
    """An amount with 4 decimals as an integer number of 1/10000."""
    return (c * F.lit(10000)).cast("bigint")


def _from_units4(c: Column) -> Column:
    return (c.cast("decimal(20,0)") * F.lit(Decimal("0.0001"))).cast(DecimalType(24, 4))


def _sum_join(a: Column, b: Column) -> Column:
    """Combine two partial SUMs: NULL only when both are NULL (no value seen)."""
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(
        F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))


def line_partials(m: InvoiceModel) -> DataFrame:
    """Per (type_of_invoice, line_key): partial sums of every line amount the
    invoice grouping needs.

    Computed from the line tables alone (plus the VAT-rate lookup), so the
    sums are combined map-side before any shuffle and the line table itself
    is never shuffled. Amounts are unsigned: a credit note's sign is one
    value per invoice and is applied afterwards, since rounding half away
    from zero is symmetric (``sum(round(-x)) = -sum(round(x))``).

    ``x_*`` sum the lines that are not invoice-wide percentage lines, ``y_*``
    the ones that are (used only when the credit flag is NULL: the source then
    falls through to the plain line value). ``pct_counts`` lists, per distinct
    entered percentage, how many invoice-wide percentage lines carry it — the
    rounded amount of such a line depends only on (invoice net, percentage),
    and the list is bounded by the number of distinct percentages.
    """
    tax = m.tax_codes.select(F.col("unique_id").alias("tc_uid"), F.col("value").alias("vat_rate"))
    df = ledger_line_sources(m).join(F.broadcast(tax), F.col("tax_code_id") == F.col("tc_uid"), "left")
    kind = F.when(F.col("type_of_invoice") == "S",
                  discount_kind(F.col("price"), F.col("discount_amount"), F.col("discount_percentage")))
    qtp = qty_times_price(F.col("qty"), F.col("price"))
    df = df.select("type_of_invoice", "line_key", "discount_percentage", "vat_rate", kind.alias("kind"),
                   qtp.alias("qtp"),
                   ledger_net(qtp, F.col("discount_amount"), F.col("discount_percentage")).alias("lv"))
    df = df.select("*", (F.col("qtp") - F.col("lv")).alias("dv"),
                   ledger_vat(F.col("lv"), F.col("vat_rate")).alias("vat"))
    return partial_sums(df)


def partial_sums(df: DataFrame) -> DataFrame:
    """:func:`line_partials` of valued lines: type_of_invoice, line_key, discount_percentage, kind, qtp, lv, dv and vat of each."""
    is2 = F.coalesce(F.col("kind") == 2, F.lit(False))
    lv, dv, vat = F.col("lv"), F.col("dv"), F.col("vat")
    keys = ["type_of_invoice", "line_key"]
    # rounded amounts are exact multiples of 0.01, so they are summed as
    # integer cents (long arithmetic; an overflow raises under ANSI mode)
    by_pct = (df.groupBy(*keys, F.when(is2, F.col("discount_percentage")).alias("pct2"))
              .agg(F.count(F.lit(1)).alias("n"),
                   F.sum(_cents(lv)).alias("p_net"),
                   F.sum(F.when(~is2, _cents(lv))).alias("x_lv"),
                   F.sum(F.when(~is2, _cents(dv))).alias("x_dv"),
                   F.sum(F.when(~is2, _cents(lv + vat))).alias("x_inc"),
                   F.sum(F.when(is2, _cents(lv))).alias("y_lv"),
                   F.sum(F.when(is2, _cents(dv))).alias("y_dv"),
                   F.sum(F.when(is2, _cents(lv + vat))).alias("y_inc"),
                   F.sum(_cents(F.col("qtp"))).alias("vnd"),
                   F.sum(_cents(vat)).alias("vat"),
                   F.sum(F.when(F.col("kind") == 1, _units4(dv))).alias("g1")))
    cents = ["p_net", "x_lv", "x_dv", "x_inc", "y_lv", "y_dv", "y_inc", "vnd", "vat"]
    pair = F.struct(F.col("pct2").alias("pct"), F.col("n").cast("decimal(18,0)").alias("n"))
    agg = (by_pct.groupBy(*keys)
           .agg(F.sum("n").alias("n_lines"), *[F.sum(c).alias(c) for c in cents + ["g1"]],
                F.collect_list(F.when(F.col("pct2").isNotNull(), pair)).alias("pct_counts")))
    return agg.select(*keys, "n_lines", "pct_counts", *[_from_cents(F.col(c)).alias(c) for c in cents],
                      _from_units4(F.col("g1")).alias("g1"))


def invoice_grouping(m: InvoiceModel, how: str, partials: DataFrame | None = None, headers: str | None = None) -> DataFrame:
    """Per invoice, sums of per-line amounts rounded to 2 dp.

    Invoice-wide percentage lines reduce the net and the gross and add to the
    discount (signs swap on a credit note); they do not reduce VAT. Their
    amount is the invoice's summed net (over every line of every context row
    with that invoice id) times the entered percentage.

    Plan: per-invoice partial sums (:func:`line_partials`) joined to the
    per-invoice context; the invoice net is a window sum over the (at most a
    few) context rows of one invoice id; the result is grouped on the 14
    context keys as the source does, so identical context rows merge.
    ``partials`` may give the partial sums from a staged result. With ``headers="inner"`` rows
    without a base header are left out; context, sums, window and groups then all meet on the
    invoice id, in one shuffle of the context.
    """
    sums = line_partials(m) if partials is None else partials
    values = [c for c in sums.columns if c not in ("type_of_invoice", "line_key")]
    # one row for each id with the sums of its (at most three) sub-types
    sums = sums.where(F.col("line_key").isNotNull()).groupBy("line_key").agg(
        F.collect_list(F.struct("type_of_invoice", *values)).alias("sums"))
    # a base header that is found has the sub-type's own id; rows without one never meet an invoice total
    key = "invoice_guid" if (headers or how) == "inner" else "line_key"
    df = invoice_context(m, how, headers).join(sums.withColumnRenamed("line_key", key), key, "left")
    own = F.filter("sums", lambda s: s["type_of_invoice"] == F.col("type_of_invoice"))
    df = df.withColumn("sums", F.get(own, F.lit(0)))
    df = df.select(*[c for c in df.columns if c != "sums"], *[F.col("sums")[c].alias(c) for c in values])
    guid = F.col("invoice_guid")
    w = Window.partitionBy(key)
    net = F.when(guid.isNotNull(), F.sum("p_net").over(w)).cast(AMOUNT)
    df = df.select("*", net.alias("invoice_net"))

    has_pct = guid.isNotNull() & (F.size("pct_counts") > 0)
    z_acc = F.aggregate("pct_counts", F.lit(0).cast("decimal(38,4)"),
                        lambda acc, p: (acc + p["n"] * _rounded(
                            invoice_wide_discount(F.col("invoice_net"), p["pct"]))).cast("decimal(38,4)"))
    # line count (12 digits) times amount (25, 10 of them decimal): exact, as is the sum with g1 below
    g2_acc = F.aggregate("pct_counts", F.lit(0).cast("decimal(34,10)"),
                         lambda acc, p: (acc + p["n"].cast("decimal(12,0)") * invoice_wide_discount(
                             F.col("invoice_net"), p["pct"]).cast("decimal(25,10)")).cast("decimal(34,10)"))
    df = df.select("*", F.when(has_pct, z_acc).alias("z"), F.when(has_pct, g2_acc).alias("g2"))

    cr = F.col("credit")
    c_false, c_true = cr == F.lit(False), cr == F.lit(True)
    x_lv, x_dv, x_inc = F.col("x_lv"), F.col("x_dv"), F.col("x_inc")
    z = F.col("z")
    excl = (F.when(c_false, _sum_join(x_lv, -z)).when(c_true, _sum_join(-x_lv, z))
            .otherwise(_sum_join(x_lv, F.col("y_lv"))))
    disc = (F.when(c_false, _sum_join(x_dv, z)).when(c_true, _sum_join(-x_dv, -z))
            .otherwise(_sum_join(x_dv, F.col("y_dv"))))
    incl = (F.when(c_false, _sum_join(x_inc, -z)).when(c_true, _sum_join(-x_inc, z))
            .otherwise(_sum_join(x_inc, F.col("y_inc"))))
    # an invoice without lines still has one row whose amounts are all 0
    no_lines = F.col("n_lines").isNull()

    def filled(c: Column) -> Column:
        return F.when(no_lines, F.lit(0)).otherwise(c)
    return (df.groupBy(*GROUP_KEYS)
            .agg(F.sum(filled(excl)).alias("excluding_vat"),
                 F.sum(filled(signed_by_credit(cr, F.col("vnd")))).alias("value_no_discount"),
                 F.sum(filled(disc)).alias("discount_value"),
                 F.sum(filled(signed_by_credit(cr, F.col("vat")))).alias("vat_amount"),
                 F.sum(filled(incl)).alias("including_vat"),
                 F.sum(_sum_join(F.col("g1"), F.col("g2"))).alias("global_discount")))


HEADER_COLS = ["auto_id", "unique_id", "id", "passed_to_accounts", "date", "order_no", "account_number",
               "is_draft", "name", "address1", "address2", "address3", "address4", "postcode",
               "credit_note", "reason", "credited_invoice_guid"]


def total_discount_percent(value_no_discount: Column, discount: Column) -> Column:
    """``100 - (vnd - disc) / vnd * 100`` with the money quotient cut at 4 dp;
    a zero-value invoice shows 100 %."""
    ratio = F.when(value_no_discount != 0, money_ratio(value_no_discount - discount, value_no_discount)) \
             .otherwise(F.lit(0))
    return (F.lit(100) - ratio * F.lit(100)).cast("double")


def invoice_combined(m: InvoiceModel, how: str, partials: DataFrame | None = None, headers: DataFrame | None = None) -> DataFrame:
    """Header columns beside the grouped sums (missing sums read 0). ``headers`` may give the header rows with more columns."""
    g = invoice_grouping(m, how, partials, "inner")
    hdr = m.base_invoice.select(*HEADER_COLS) if headers is None else headers
    more = [c for c in hdr.columns if c not in HEADER_COLS]
    df = hdr.join(g, hdr["unique_id"] == g["invoice_guid"], _check_how(how))
    z = F.lit(0)
    vnd = F.coalesce(F.col("value_no_discount"), z)
    disc = F.coalesce(F.col("discount_value"), z)
    gsign = signed_by_credit(F.col("credit_note"), F.col("global_discount"))
    return df.select(
        "invoice_type", "auto_id", "unique_id", "id", "customer_auto_id", "customer_id", "customer_name",
        "passed_to_accounts", "site_auto_id", "site_id", "site", "ppm_contract_id", "job_id", "job_auto_id",
        "date", "description", "user_id", "order_no", "account_number", "is_draft", "name", "address1",
        "address2", "address3", "address4", "postcode", "credit_note", "reason", "credited_invoice_guid",
        F.coalesce(F.col("vat_amount"), z).alias("vat_value"),
        F.coalesce(F.col("excluding_vat"), z).alias("invoice_value"),
        F.coalesce(F.col("including_vat"), z).alias("total_including_vat"),
        disc.alias("total_discount_value"), vnd.alias("value_no_discount"),
        total_discount_percent(vnd, disc).alias("total_discount_percent"),
        "type_of_invoice",
        F.coalesce(gsign, z).alias("global_discount"), *more)


def credited_headers(m: InvoiceModel) -> DataFrame:
    """Header rows with the credited invoice's id, number, draft flag and date (NULL if none). Only the pairs of ids are looked
    up; they come back to the headers by the header's own id, on which the sums meet them too."""
    hdr = m.base_invoice.select(*HEADER_COLS)
    ci = m.base_invoice.select(F.col("unique_id").alias("to"), F.col("auto_id").alias("credit_id"),
                               F.col("id").alias("credit_number"), F.col("is_draft").alias("credit_is_draft"),
                               F.col("date").alias("credit_date_raised"))
    pairs = (hdr.where(F.col("unique_id").isNotNull() & F.col("credited_invoice_guid").isNotNull())
             .select("unique_id", F.col("credited_invoice_guid").alias("to")).distinct())
    found = (pairs.join(ci, "to").groupBy("unique_id").agg(F.collect_list(F.struct(*ci.columns)).alias("found")))
    df = hdr.join(found, "unique_id", "left").select(
        *HEADER_COLS, F.explode_outer(F.filter("found", lambda c: c["to"] == F.col("credited_invoice_guid"))).alias("c"))
    return df.select(*HEADER_COLS, *[F.col("c")[c].alias(c) for c in ci.columns[1:]])


def invoice_totals(m: InvoiceModel, how: str, partials: DataFrame | None = None) -> DataFrame:
    """Invoice totals with the credited invoice's id, number, draft flag
    and date, amounts rounded to 2 dp."""
    df = invoice_combined(m, how, partials, credited_headers(m))
    r2 = lambda c: round2(F.col(c)).alias(c)
    return df.select(
        "invoice_type", F.col("auto_id").alias("invoice_auto_id"), "unique_id",
        F.col("id").alias("invoice_number"), "customer_auto_id", "customer_id", "customer_name",
        "passed_to_accounts", "site_auto_id", "site_id", F.col("site").alias("site_name"), "ppm_contract_id",
        "job_id", "job_auto_id", F.col("date").alias("date_raised"), F.col("description").alias("job_description"),
        "user_id", F.col("order_no").alias("order_number"), "account_number", "is_draft", "name", "address1",
        "address2", "address3", "address4", "postcode", "credit_note", F.col("reason").alias("credit_reason"),
        "credit_id", "credited_invoice_guid", "credit_number", "credit_is_draft", "credit_date_raised",
        r2("vat_value"), r2("invoice_value"), r2("total_including_vat"), r2("total_discount_value"),
        r2("value_no_discount"), F.col("global_discount").cast(MONEY).alias("global_discount"),
        # already exact at 2 dp (see total_discount_percent), so ROUND(.., 2) is the identity
        "total_discount_percent", "type_of_invoice")


__all__ = ["invoice_context", "ledger_line_sources", "line_context", "coded_lines", "ledger_values",
           "invoice_nets", "with_global_discount", "line_partials", "partial_sums", "invoice_grouping", "invoice_combined",
           "invoice_totals", "total_discount_percent", "GROUP_KEYS"]
