"""The rewritten Spark plans against the reference-form SQL on hand-built
edge rows the shared test tables do not contain: NULL credit and draft flags,
invoice rows without a base header, a standard invoice without a job, NULL
quantity or price, credit notes carrying invoice-wide discounts, payment
rows of equal amounts from two sources, text line ids '' meeting cost rows,
purchase invoices of NULL and unknown type, order lines naming two lines.

The model tables are handed to DuckDB as Arrow tables (exact decimal and
timestamp types) under the names the oracle chains read (``t_<table>``).
"""

import datetime as dt

import duckdb
import pytest
from conftest import D

from checks.catalog import CHAIN_WITH, ORACLE_BODY, SPARK, decimals_to_double
from checks.compare import rows_of
from tallybook.sources.model import SCHEMA

T1 = dt.datetime(2024, 3, 31, 23, 30)
T2 = dt.datetime(2024, 10, 27, 0, 30)


def _bi(i, **kw):
    row = dict(unique_id=i, auto_id=i, id=f"INV{i}", credit_note=False, is_draft=False, passed_to_accounts=False,
               date=T1, order_no=f"PO{i}")
    row.update(kw)
    return row


def _line(uid, inv, **kw):
    row = dict(unique_id=uid, auto_id=uid, invoice_guid=inv, created_at=T2, details=f"line {uid}")
    row.update(kw)
    return row


@pytest.fixture(scope="module")
def edge(spark):
    from conftest import model
    return model(
        spark,
        base_invoice=[_bi(100, credit_note=None), _bi(101), _bi(102, credit_note=True, credited_invoice_guid=101),
                      _bi(103, credit_note=None), _bi(104, is_draft=None), _bi(106), _bi(107, date=T2),
                      _bi(108, passed_to_accounts=True)],
        invoice=[dict(unique_id=i, job_auto_id=300) for i in (100, 101, 102, 105, 107)]
        + [dict(unique_id=106, job_auto_id=999)],
        job=[dict(auto_id=300, id="J300", customer_auto_id=1, site_auto_id=1, description="visit")],
        customer=[dict(auto_last_id=1, unique_id=1, id="C1", account_number="ACC1"),
                  dict(auto_last_id=2, unique_id=2, id="C2", account_number="ACC2")],
        contract=[dict(auto_id=1, id="S1", site="one", account_number=" ")],
        ppm_invoices=[dict(unique_id=104, ppm_contract_id=1)],
        ppm_contract=[dict(unique_id=1, ppm_contract_number="PPM1", customer_auto_id=2)],
        cg_invoice=[dict(unique_id=103, customer_auto_id=None), dict(unique_id=108, customer_auto_id=2)],
        tax_codes=[dict(unique_id=1, code="T1", value=D(20), description="Standard"),
                   dict(unique_id=2, code="T2", value=D("17.5"), description="Odd")],
        nominal_codes=[dict(unique_id=10, code="N10")],
        invdets=[
            _line("a1", 100, qty=D(3), price=D("3.33"), discount_percentage=D(10), tax_code_id=2, nominal_code_id=10),
            _line("a2", 100, qty=D(1), price=D(0), discount_percentage=D("12.5")),
            _line("a3", 100, qty=D(1), price=D(0), discount_amount=D(2), tax_code_id=1),
            _line("b1", 101, qty=D(1), price=D("99.99"), discount_amount=D("0.99"), tax_code_id=1),
            _line("b2", 101, qty=D(1), price=D(0), discount_percentage=D(5)),
            _line("c1", 102, qty=D(1), price=D(50), tax_code_id=1),
            _line("c2", 102, qty=D(1), price=D(0), discount_percentage=D(10)),
            _line("e1", 105, qty=D(1), price=D(10), tax_code_id=1),
            _line("e2", 105, qty=D(1), price=D(0), discount_percentage=D(10)),
            _line("f1", 106, qty=D(1), price=D(7), tax_code_id=1),
            _line("g1", 107, qty=None, price=D(5), tax_code_id=3),
            _line("g2", 107, qty=D(2), price=None, discount_amount=D(1), nominal_code_id=10)],
        ppm_lines=[dict(unique_id="p1", invoice_id=104, quantity=D(1), price_per_unit=D(20),
                        discount_percentage=D(10), tax_code_id=1, description="ppm line", created_at=T2)],
        cg_lines=[dict(unique_id="q1", invoice_guid=103, qty=D(1), price=D(30), tax_code_id=2, details="grouped",
                       job_auto_id=300, created_at=T2)],
        invoice_payments=[dict(invoice_guid=100, amount=D(5)), dict(invoice_guid=101, amount=D(10)),
                          dict(invoice_guid=101, amount=D(10))],
        cg_payments=[dict(invoice_guid=101, amount=D(20)), dict(invoice_guid=103, amount=None)],
        ppm_payments=[dict(ppm_contract_invoice_id=104, amount=None)],
        cost=[dict(invoice_line_id="", cost_type_id=9, engineer_auto_id=1),
              dict(invoice_line_id="a1", cost_type_id=5, engineer_auto_id=1)],
        qcost=[dict(invoice_line_id="", cost_type_id=5, schedule_of_rates_item_id=None, stock_item_id=2),
               dict(invoice_line_id="b1", cost_type_id=9, schedule_of_rates_item_id=4, stock_item_id=None)],
        sor_item=[dict(id=4, code="SR4")],
        stock_part=[dict(stock_item_id=2, number="PN2")],
        engineer=[dict(auto_last_id=1)],
        users=[dict(user_id=1, full_name="One", engineer_id=1, reference="E1")],
        control=[dict(timezone="Europe/London")],
        supplier_invoice=[dict(unique_id=i, purchase_order_id=i, invoice_number=f"PI{i}", type=t, date=T1,
                               passed_to_accounts=False) for i, t in ((200, None), (201, 0), (202, 1), (203, 3))],
        supplier_invoice_lines=[
            dict(unique_id="s1", supplier_invoice_id=200, quantity=D(1), price_per_unit=D(10), tax_code_id=1),
            dict(unique_id="s2", supplier_invoice_id=201, quantity=D(3), price_per_unit=D("3.33"),
                 discount_percentage=D("12.5"), discount_amount=D("0.5"), tax_code_id=2, description="x" * 40),
            dict(unique_id="s3", supplier_invoice_id=202, quantity=D(2), price_per_unit=D("4.99"),
                 overridden_tax_amount=D("1.23"), discount_amount=D(1)),
            dict(unique_id="s4", supplier_invoice_id=203, quantity=D(1), price_per_unit=D(1))],
        purchase_order_lines=[dict(supplier_invoice_line_id="s2", supplier_credit_line_id="s3", part_number="A"),
                              dict(supplier_invoice_line_id=None, supplier_credit_line_id="s2", part_number="B")],
        purchase_order=[dict(unique_id=201, po_number="PO201", job_auto_id=300, supplier_id=1)],
        supplier=[dict(id=1, account_number="SUP1")],
        subcontractor_invoice=[dict(unique_id=i, purchase_order_id=i, invoice_number=f"PS{i}", type=t, date=T2,
                                    passed_to_accounts=False) for i, t in ((210, 0), (211, 2))],
        subcontractor_invoice_lines=[
            dict(unique_id="u1", subcontractor_invoice_id=210, quantity=D(3), price_per_unit=D("3.33"),
                 tax_code_id=2),
            dict(unique_id="u2", subcontractor_invoice_id=211, quantity=D(1), price_per_unit=D(8), tax_code_id=1)],
        subcontractor_po_lines=[dict(invoice_line_id="u1", credit_line_id="u1")],
    )


@pytest.fixture(scope="module")
def duck(edge):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in SCHEMA:
        con.register(f"t_{name}", getattr(edge, name).toArrow())
    return con


KEYS = ["bz_invoice_grouping", "ag_wide_keys", "bz_invoice_combined", "bz_invoice_totals", "bz_global_discount",
        "bz_line_context", "bz_rounded_lines", "bz_invoice_gross", "bz_invoice_credit_combine", "bz_payment_status",
        "bz_receivable", "bz_receivable_ppm", "rp_customers", "rp_sales", "rp_purchase", "jn_or_keys",
        "bz_supplier_line", "bz_subcontractor_line", "wn_first_value", "so_union_coerce", "jn_fanout"]


@pytest.mark.parametrize("key", KEYS)
def test_edge_rows_match_reference_form(edge, duck, key):
    sdf = decimals_to_double(SPARK[key](edge))
    rel = duck.sql(f"{CHAIN_WITH}\n{ORACLE_BODY[key]}")
    assert sorted(sdf.columns) == sorted(rel.columns)
    so = sorted(range(len(sdf.columns)), key=lambda i: sdf.columns[i])
    oo = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    srows = rows_of([tuple(r[i] for i in so) for r in sdf.collect()])
    orows = rows_of([tuple(r[i] for i in oo) for r in rel.fetchall()])
    assert srows == orows, (srows - orows, orows - srows)
