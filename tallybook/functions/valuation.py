"""Line valuation rules (Column -> Column), one function per rule.

Two rules value the same sales line differently and both are needed:

* settlement (rule 1) rounds the net and the VAT of every line on its own;
* ledger (rule 2) rounds only the net per line and leaves VAT unrounded until
  the invoice is summed.

Purchase lines have their own rules for supplier and subcontractor invoices.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook.functions.money import (AMOUNT, money, one_minus_pct, pct_factor,
                                       product, rate_or_zero, round2)


# --------------------------------------------------------------------------- #
# sales lines, settlement rule                                                #
# --------------------------------------------------------------------------- #
def settlement_net(qty: Column, price: Column, disc_amt: Column, disc_pct: Column) -> Column:
    """Net of one line: a fixed discount wins over a percentage; an undiscounted
    line is first cast to money (4 dp) and then rounded to 2 dp."""
    qp = product(qty, price)
    v = (F.when(disc_amt.isNotNull(), round2(qp - disc_amt))
          .when(disc_pct.isNotNull(), round2(qp * one_minus_pct(disc_pct)))
          .otherwise(round2(money(qp))))
    return money(v)


def settlement_vat(qty: Column, price: Column, disc_amt: Column, disc_pct: Column,
                   vat_rate: Column) -> Column:
    """VAT of one line from the *unrounded* discounted net, rounded to 2 dp."""
    qp = product(qty, price)
    r = rate_or_zero(vat_rate)
    v = (F.when(disc_amt.isNotNull(), round2((qp - disc_amt) * r))
          .when(disc_pct.isNotNull(), round2(qp * one_minus_pct(disc_pct) * r))
          .otherwise(round2(money(qp * r))))
    return money(v)


# --------------------------------------------------------------------------- #
# sales lines, ledger rule                                                    #
# --------------------------------------------------------------------------- #
def qty_times_price(qty: Column, price: Column) -> Column:
    """``COALESCE(qty * price, 0)`` — a line with no quantity or price is 0."""
    return F.coalesce(product(qty, price), F.lit(0))


def ledger_net(qtp: Column, disc_amt: Column, disc_pct: Column) -> Column:
    """Rounded net of one line from ``qtp`` (see :func:`qty_times_price`)."""
    v = (F.when(disc_amt.isNotNull(), qtp - disc_amt)
          .when(disc_pct.isNotNull(), qtp * one_minus_pct(disc_pct))
          .otherwise(qtp))
    return round2(v).cast(AMOUNT)


def ledger_vat(net: Column, vat_rate: Column) -> Column:
    """Unrounded VAT: ``net * ISNULL(rate, 0) / 100``."""
    return net * rate_or_zero(vat_rate)


def discount_kind(price: Column, disc_amt: Column, disc_pct: Column) -> Column:
    """Discount-line kind of a standard line.

    1: a zero-price line carrying a fixed discount; 2: a zero-price line
    carrying an invoice-wide percentage; 0: an ordinary line.
    """
    return (F.when(disc_amt.isNotNull() & (price == 0), F.lit(1))
             .when(disc_pct.isNotNull() & (price == 0), F.lit(2))
             .otherwise(F.lit(0)))


def invoice_wide_discount(invoice_net: Column, entered_pct: Column) -> Column:
    """Amount of an invoice-wide percentage line: invoice net x pct / 100."""
    return invoice_net.cast(AMOUNT) * pct_factor(entered_pct)


# --------------------------------------------------------------------------- #
# purchase lines                                                              #
# --------------------------------------------------------------------------- #
def _by_purchase_type(ptype: Column, x: Column) -> Column:
    """Type 1 (credit) negates, type 0 keeps, any other type gives NULL."""
    return F.when(ptype == 1, -x).when(ptype == 0, x)


def supplier_line(ptype: Column, qty: Column, ppu: Column, disc_pct: Column,
                  disc_amt: Column, overridden_tax: Column, vat_rate: Column) -> dict[str, Column]:
    """All amounts of one supplier-invoice line.

    The gross is rounded first, the percentage discount is rounded on the
    rounded gross, and the fixed discount is subtracted *after* the sign is
    applied to the net (so a credit's net is ``-(gross - pct) - fixed``), but
    inside the sign for VAT and the total.
    """
    gross = round2(product(qty, ppu))
    pct_disc = F.coalesce(round2(gross * pct_factor(disc_pct)), F.lit(0))
    fixed = F.coalesce(disc_amt, F.lit(0))
    net_unsigned = gross - pct_disc - fixed
    vat_calc = F.coalesce(round2(net_unsigned * pct_factor(vat_rate)), F.lit(0))
    vat_unsigned = F.when(overridden_tax.isNotNull(), overridden_tax).otherwise(vat_calc)
    return {
        "pct_discount": pct_disc,
        "total_excluding_vat": _by_purchase_type(ptype, gross),
        "discount_total": _by_purchase_type(ptype, pct_disc) + fixed,
        "net": _by_purchase_type(ptype, gross - pct_disc) - fixed,
        "vat": _by_purchase_type(ptype, vat_unsigned),
        "total_including_vat": _by_purchase_type(ptype, net_unsigned + vat_unsigned),
    }


def subcontractor_line(ptype: Column, qty: Column, ppu: Column, vat_rate: Column) -> dict[str, Column]:
    """Subcontractor line: not rounded; anything but type 0 counts as a credit."""
    gross = product(qty, ppu)
    vat = gross * pct_factor(vat_rate)
    credit = ~(F.coalesce(ptype == 0, F.lit(False)))
    return {
        "net": F.when(credit, -gross).otherwise(gross),
        "vat": F.when(credit, -vat).otherwise(vat),
    }
