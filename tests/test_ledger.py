"""Ledger totals (invoice grouping, header, totals) on hand-built invoices.

Invoice 10 (standard): L1 1 x 100.00 at 20 %; L2 an invoice-wide 10 % line
  (price 0); L3 a fixed-discount line of 5.00 (price 0), no VAT.
  Invoice net = 100 + 0 - 5 = 95.00, so L2 is worth 9.50.
  excluding VAT 100 - 9.50 - 5 = 85.50; undiscounted 100; discount 0 + 9.50 + 5 = 14.50;
  VAT 20.00; gross 120 - 9.50 - 5 = 105.50; global discount 9.50 + 5.00 = 14.50.
Invoice 11 (standard credit note): 1 x 50.00 at 20 % -> every amount negated.
Invoice 12 (customer-grouped, no lines): all 0, global discount NULL.
"""

import datetime as dt

import pytest
from conftest import D

from tallybook.plans import ledger

T0 = dt.datetime(2024, 3, 1)


def _model(mk):
    bi = [dict(unique_id=10, auto_id=10, id="INV10", credit_note=False, is_draft=False, passed_to_accounts=False,
               date=T0),
          dict(unique_id=11, auto_id=11, id="INV11", credit_note=True, credited_invoice_guid=10, is_draft=False,
               passed_to_accounts=False, date=T0),
          dict(unique_id=12, auto_id=12, id="INV12", credit_note=False, is_draft=False, passed_to_accounts=False,
               date=T0)]
    return mk(
        base_invoice=bi,
        invoice=[dict(unique_id=10, job_auto_id=200), dict(unique_id=11, job_auto_id=200)],
        job=[dict(auto_id=200, id="J200", customer_auto_id=7, site_auto_id=1)],
        customer=[dict(auto_last_id=7, unique_id=7, id="C7", name="Seven")],
        contract=[dict(auto_id=1, id="S1", site="Site one")],
        cg_invoice=[dict(unique_id=12, customer_auto_id=7)],
        tax_codes=[dict(unique_id=1, code="T1", value=D(20))],
        invdets=[dict(unique_id="L1", auto_id="L1", invoice_guid=10, qty=D(1), price=D(100), tax_code_id=1),
                 dict(unique_id="L2", auto_id="L2", invoice_guid=10, qty=D(1), price=D(0),
                      discount_percentage=D(10)),
                 dict(unique_id="L3", auto_id="L3", invoice_guid=10, qty=D(1), price=D(0), discount_amount=D(5)),
                 dict(unique_id="L4", auto_id="L4", invoice_guid=11, qty=D(1), price=D(50), tax_code_id=1)],
    )


@pytest.mark.parametrize("how", ["inner", "left"])
def test_invoice_grouping(mk, how):
    g = {r.invoice_guid: r for r in ledger.invoice_grouping(_model(mk), how).collect()}
    assert set(g) == {10, 11, 12}
    r = g[10]
    assert (r.excluding_vat, r.value_no_discount, r.discount_value, r.vat_amount, r.including_vat,
            r.global_discount) == (D("85.50"), D(100), D("14.50"), D(20), D("105.50"), D("14.50"))
    r = g[11]
    assert (r.excluding_vat, r.value_no_discount, r.discount_value, r.vat_amount, r.including_vat,
            r.global_discount) == (D(-50), D(-50), 0, D(-10), D(-60), None)
    r = g[12]
    assert (r.excluding_vat, r.including_vat, r.global_discount) == (0, 0, None)
    assert (g[10].customer_id, g[10].site, g[10].job_id, g[12].site) == ("C7", "Site one", "J200", None)


def test_discount_kinds(mk):
    kinds = {r.line_unique_id: r.discount_line for r in ledger.line_context(_model(mk), "inner").collect()}
    assert kinds == {"L1": 0, "L2": 2, "L3": 1, "L4": 0, None: None}


def test_global_line_amount(mk):
    rows = ledger.with_global_discount(_model(mk), "inner").where("discount_line = 2").collect()
    assert [(r.line_unique_id, r.global_line_value) for r in rows] == [("L2", D("9.500000"))]


def test_invoice_totals_discount_percent_and_credit(mk):
    t = {r.unique_id: r for r in ledger.invoice_totals(_model(mk), "inner").collect()}
    assert t[10].total_discount_percent == pytest.approx(14.5)
    assert t[12].total_discount_percent == 100.0          # Q6: a zero-value invoice shows 100 %
    assert t[11].total_discount_percent == 0.0
    assert t[10].global_discount == D("14.5000")
    assert t[11].global_discount == 0                      # NULL global discount reads 0
    assert (t[11].credit_number, t[11].credit_id) == ("INV10", 10)
    assert t[10].invoice_value == D("85.50")


def test_settlement_and_ledger_rules_differ(mk):
    # Q2: one line of 0.50 x 0.05 = 0.025 with a 0 % discount at 50 % VAT.
    # settlement: net round(0.025) = 0.03, VAT round(0.025 x 0.5 = 0.0125) = 0.01 -> 0.04
    # ledger:     net 0.03, VAT from the rounded net 0.015 -> 0.02             -> 0.05
    from tallybook.plans import settlement
    m = mk(base_invoice=[dict(unique_id=1, auto_id=1, id="INV1", credit_note=False, is_draft=False,
                              passed_to_accounts=False, date=T0)],
           cg_invoice=[dict(unique_id=1)],
           cg_lines=[dict(unique_id="x", invoice_guid=1, qty=D("0.5"), price=D("0.05"),
                          discount_percentage=D(0), tax_code_id=5)],
           tax_codes=[dict(unique_id=5, code="H", value=D(50))])
    gross = settlement.invoice_gross(m).first().total_including_vat
    grouped = ledger.invoice_grouping(m, "inner").first()
    assert gross == D("0.04")
    assert (grouped.excluding_vat, grouped.vat_amount, grouped.including_vat) == (D("0.03"), D("0.02"), D("0.05"))
