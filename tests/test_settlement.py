"""Settlement chain on hand-built invoices (expected values worked out by hand).

Invoice 1  standard, two lines: 2 x 10.00 at 20 % -> 24.00; 1 x 5.00 less 1.00 at 20 % -> 4.80
Invoice 2  standard whose job is missing: its line is left out (Q5), total 0
Invoice 3  PPM, 3 x 3.33 less 10 % at 20 %: net 8.99, VAT 1.80 -> 10.79
Invoice 4  customer-grouped credit note against invoice 1: 10.00 -> -10.00
Invoice 5  draft: no settlement row
Invoice 6  customer-grouped, no lines: due 0 -> Paid (Q15)
Payments   invoice 1: 10.00 + 5.00 (standard) and 15.00 (grouped): two rows of the
           same amount, so one status row counting the invoice twice (Q4);
           invoice 3: 20.00 (PPM)
"""

import datetime as dt

from conftest import D

from tallybook.plans import settlement

T0 = dt.datetime(2024, 3, 1)


def _model(mk):
    bi = [dict(unique_id=i, auto_id=i, id=f"INV{i}", credit_note=False, is_draft=False, passed_to_accounts=False,
               date=T0) for i in (1, 2, 3, 5, 6)]
    bi.append(dict(unique_id=4, auto_id=4, id="INV4", credit_note=True, credited_invoice_guid=1, is_draft=False,
                   passed_to_accounts=False, date=T0))
    bi[3]["is_draft"] = True  # invoice 5
    return mk(
        base_invoice=bi,
        invoice=[dict(unique_id=1, job_auto_id=100), dict(unique_id=2, job_auto_id=999),
                 dict(unique_id=5, job_auto_id=100)],
        job=[dict(auto_id=100, id="J100")],
        ppm_invoices=[dict(unique_id=3, ppm_contract_id=1)],
        cg_invoice=[dict(unique_id=4), dict(unique_id=6)],
        tax_codes=[dict(unique_id=1, code="T1", value=D(20))],
        invdets=[dict(unique_id="a", auto_id="a", invoice_guid=1, qty=D(2), price=D(10), tax_code_id=1),
                 dict(unique_id="b", auto_id="b", invoice_guid=1, qty=D(1), price=D(5), discount_amount=D(1),
                      tax_code_id=1),
                 dict(unique_id="c", auto_id="c", invoice_guid=2, qty=D(1), price=D(50), tax_code_id=1),
                 dict(unique_id="d", auto_id="d", invoice_guid=5, qty=D(1), price=D(70), tax_code_id=1)],
        ppm_lines=[dict(unique_id="e", invoice_id=3, quantity=D(3), price_per_unit=D("3.33"),
                        discount_percentage=D(10), tax_code_id=1)],
        cg_lines=[dict(unique_id="f", invoice_guid=4, qty=D(1), price=D(10))],
        invoice_payments=[dict(invoice_guid=1, amount=D(10)), dict(invoice_guid=1, amount=D(5))],
        cg_payments=[dict(invoice_guid=1, amount=D(15))],
        ppm_payments=[dict(ppm_contract_invoice_id=3, amount=D(20))],
    )


def test_line_values_rule1(mk):
    m = _model(mk)
    got = sorted((r.invoice_guid, r.line_value, r.vat_value) for r in settlement.valued_settlement_lines(m).collect())
    assert got == [(1, D("4.0000"), D("0.8000")), (1, D("20.0000"), D("4.0000")),
                   (3, D("8.9900"), D("1.8000")), (4, D("10.0000"), D("0.0000"))]


def test_invoice_gross_and_credits(mk):
    m = _model(mk)
    g = {r.unique_id: r.total_including_vat for r in settlement.invoice_gross(m).collect()}
    assert g == {1: D("28.80"), 2: 0, 3: D("10.79"), 4: D("-10.00"), 6: 0}
    c = {r.credited_invoice_guid: r.total_credit for r in settlement.credit_totals(settlement.invoice_gross(m)).collect()}
    assert c == {1: D("-10.00")}


def test_payment_status(mk):
    m = _model(mk)
    rows = {r.invoice_guid: r for r in settlement.payment_status(m).collect()}
    assert set(rows) == {1, 2, 3, 6}
    r1 = rows[1]
    assert (r1.invoice_total, r1.invoice_total_inc_credits, r1.paid, r1.payment_status) == \
        (D("57.60"), D("37.60"), D("15.00"), "Partially Paid")
    assert rows[2].payment_status == "Paid" and rows[2].invoice_total == 0
    assert (rows[3].paid, rows[3].payment_status) == (D("20.00"), "Paid")
    assert (rows[6].paid, rows[6].payment_status) == (0, "Paid")


def test_two_row_combine_matches_single_pass(mk):
    m = _model(mk)
    two = (settlement.invoice_credit_combine(m).groupBy("invoice_guid")
           .agg({"total_including_vat": "sum", "total_credit": "sum"}).collect())
    two = {r["invoice_guid"]: (r["sum(total_including_vat)"], r["sum(total_credit)"]) for r in two}
    one = {r.invoice_guid: (r.invoice_total, r.invoice_total_inc_credits - r.invoice_total)
           for r in settlement.invoice_with_credits(m).collect()}
    assert two == one
