"""Customer report: balances (Q1, Q3), tags, id lists, flags."""

import datetime as dt

from conftest import D

from tallybook.plans import customers

T0 = dt.datetime(2024, 3, 1)


def _bi(i, draft=False):
    return dict(unique_id=i, auto_id=i, id=f"INV{i}", credit_note=False, is_draft=draft, passed_to_accounts=False,
                date=T0)


def _model(mk):
    return mk(
        base_invoice=[_bi(20), _bi(21), _bi(22, draft=True)],
        # customer 1: only a PPM invoice of 10.00, unpaid
        ppm_contract=[dict(unique_id=1, ppm_contract_number="PPM1", customer_auto_id=1)],
        ppm_invoices=[dict(unique_id=20, ppm_contract_id=1)],
        ppm_lines=[dict(unique_id="p", invoice_id=20, quantity=D(1), price_per_unit=D(10))],
        # customer 2: a standard invoice of 20.00 paid 5.00, and a draft of 100.00
        invoice=[dict(unique_id=21, job_auto_id=300), dict(unique_id=22, job_auto_id=300)],
        job=[dict(auto_id=300, id="J300", customer_auto_id=2)],
        invdets=[dict(unique_id="s", auto_id="s", invoice_guid=21, qty=D(1), price=D(20)),
                 dict(unique_id="d", auto_id="d", invoice_guid=22, qty=D(1), price=D(100))],
        invoice_payments=[dict(invoice_guid=21, amount=D(5))],
        customer=[dict(auto_last_id=1, unique_id=1, id="C1", inactive=False, job_type_ids="1, 2,9",
                       job_category_ids="", impact_job_priority=True, show_in_bo=None),
                  dict(auto_last_id=2, unique_id=2, id="C2", inactive=True, job_type_ids=None,
                       job_category_ids="2", impact_job_priority=None, show_in_bo=False),
                  dict(auto_last_id=3, unique_id=3, id="C3", inactive=None, job_type_ids="")],
        jobctl=[dict(auto_id=1, description="Plumbing"), dict(auto_id=2, description="Electrics"),
                dict(auto_id=0, description="General")],
        job_category=[dict(auto_id=2, description="Reactive")],
        tag=[dict(unique_id=1, title="Gold"), dict(unique_id=2, title="Area North")],
        tag_level=[dict(level_id=1, tag_id=1, entity_type=1), dict(level_id=1, tag_id=2, entity_type=1),
                   dict(level_id=2, tag_id=1, entity_type=2)],
        sor_link=[dict(customer_id=1, library_id=5, is_default=True, uplift=D("2.5")),
                  dict(customer_id=2, library_id=5, is_default=False, discount=D(3))],
        sor_library=[dict(id=5, description="Main")],
    )


def test_balances_one_pass_matches_two_pass(mk):
    b = {r.customer_auto_id: (r.balance, r.ex_ppm_balance, r.ppm_balance)
         for r in customers.receivable_balances(_model(mk)).collect()}
    # customer 1: only PPM -> no ex-PPM row -> PPM balance NULL (Q1); customer 2: the
    # draft has no settlement row and adds nothing (Q3)
    assert b == {1: (D("10.00"), None, None), 2: (D("15.00"), D("15.00"), D("0.00"))}


def test_report(mk):
    r = {row["ID"]: row for row in customers.customers_report(_model(mk)).collect()}
    assert set(r) == {"C1", "C2", "C3"}
    c1, c2, c3 = r["C1"], r["C2"], r["C3"]
    assert (c1["Total Receivable Balance"], c1["Standard/CG Receivable Balance"], c1["PPM Receivable Balance"]) \
        == (D("10.00"), 0, 0)
    assert (c2["Total Receivable Balance"], c2["PPM Receivable Balance"]) == (D("15.00"), D("0.00"))
    assert c3["Total Receivable Balance"] == 0
    assert c1["Customer Tags"] == "Area North, Gold" and c2["Customer Tags"] is None
    assert c1["Job Types Assigned"] == "Electrics, Plumbing"      # 9 matches nothing
    assert c3["Job Types Assigned"] == "General"                   # '' reads as id 0
    assert c2["Job Types Assigned"] is None
    assert c1["Job Categories Assigned"] is None and c2["Job Categories Assigned"] == "Reactive"
    assert (c1["Active"], c2["Active"], c3["Active"]) == (True, False, None)
    assert (c1["Impact Job Priority (Yes/No)"], c2["Impact Job Priority (Yes/No)"]) == ("Yes", "No")
    assert (c1["Filter in Back Office (Yes/No)"], c2["Filter in Back Office (Yes/No)"]) == ("Yes", "No")
    assert c1["Uplift/Discount %"] == "Uplift-2.50%" and c2["Uplift/Discount %"] is None
    assert c1["Default SOR Library"] == "Main" and c2["Default SOR Library"] is None


def test_ppm_invoice_has_contract_but_no_job(mk):
    # Q8: a PPM invoice carries its contract id; its job id is NULL (the
    # contract number goes to a column the source drops)
    from tallybook.plans import ledger
    t = {r.unique_id: r for r in ledger.invoice_totals(_model(mk), "inner").collect()}
    assert (t[20].type_of_invoice, t[20].ppm_contract_id, t[20].job_id, t[20].customer_id) == ("P", 1, None, "C1")
    assert (t[21].type_of_invoice, t[21].job_id, t[21].ppm_contract_id) == ("S", "J300", None)
