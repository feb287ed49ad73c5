"""Typed schemas of the invoice-model tables for hand-built test rows."""

from tallybook.sources.model import SCHEMA

_D = "decimal(9,2)"
_P = "decimal(12,2)"
_PCT = "decimal(5,2)"
_LINE = (f"unique_id string, auto_id string, invoice_guid bigint, qty {_D}, price {_P}, discount_amount {_P}, "
         f"discount_percentage {_PCT}, tax_code_id int, nominal_code_id bigint, details string, "
         f"credited_invoice_line_id string, created_at timestamp_ntz")

DDL = {
    "base_invoice": "unique_id bigint, auto_id bigint, id string, credit_note boolean, credited_invoice_guid bigint, "
                    "is_draft boolean, passed_to_accounts boolean, date timestamp_ntz, order_no string, "
                    "account_number string, name string, address1 string, address2 string, address3 string, "
                    "address4 string, postcode string, reason string",
    "invoice": "unique_id bigint, job_auto_id bigint, user_id bigint",
    "invdets": _LINE,
    "ppm_invoices": "unique_id bigint, ppm_contract_id bigint",
    "ppm_lines": f"unique_id string, invoice_id bigint, quantity {_D}, price_per_unit {_P}, discount_amount {_P}, "
                 f"discount_percentage {_PCT}, tax_code_id int, nominal_code_id bigint, description string, "
                 f"created_at timestamp_ntz",
    "ppm_contract": "unique_id bigint, ppm_contract_number string, description string, customer_auto_id bigint, "
                    "site_auto_id bigint",
    "cg_invoice": "unique_id bigint, customer_auto_id bigint",
    "cg_lines": f"unique_id string, invoice_guid bigint, qty {_D}, price {_P}, discount_amount {_P}, "
                f"discount_percentage {_PCT}, tax_code_id int, nominal_code_id bigint, details string, "
                f"job_auto_id bigint, credited_invoice_line_guid string, created_at timestamp_ntz",
    "invoice_payments": f"invoice_guid bigint, amount {_P}",
    "ppm_payments": f"ppm_contract_invoice_id bigint, amount {_P}",
    "cg_payments": f"invoice_guid bigint, amount {_P}",
    "tax_codes": f"unique_id int, code string, value {_PCT}, description string",
    "nominal_codes": "unique_id bigint, code string",
    "job": "auto_id bigint, id string, customer_auto_id bigint, site_auto_id bigint, description string",
    "customer": "auto_last_id bigint, unique_id bigint, id string, name string, address1 string, address2 string, "
                "address3 string, address4 string, postcode string, custom_reference string, contact string, "
                "telephone string, email_address string, vat_number string, account_number string, "
                "warning1_used boolean, warning1_comments string, warning2_used boolean, warning2_comments string, "
                "warning3_used boolean, warning3_comments string, inactive boolean, job_type_ids string, "
                "job_category_ids string, job_type_category_description string, impact_job_priority boolean, "
                "show_in_bo boolean, show_in_portal boolean, show_in_mobile boolean, cust_type_id bigint, "
                "selling_rate_id bigint, account_manager_id bigint, fc_library_auto_id bigint",
    "contract": "auto_id bigint, id string, site string, account_number string",
    "tag_level": "level_id bigint, tag_id bigint, entity_type bigint",
    "tag": "unique_id bigint, title string",
    "jobctl": "auto_id int, description string",
    "job_category": "auto_id int, description string",
    "customer_types": "cust_type_id bigint, description string",
    "selling_rates": "id bigint, description string",
    "users": "user_id bigint, full_name string, engineer_id bigint, reference string",
    "sor_link": "customer_id bigint, library_id bigint, is_default boolean, uplift decimal(9,2), "
                "discount decimal(9,2)",
    "sor_library": "id bigint, description string",
    "fault_code_library": "auto_id bigint, description string",
    "control": "timezone string",
    "supplier_invoice": "unique_id bigint, purchase_order_id bigint, invoice_number string, type int, "
                        "date timestamp_ntz, passed_to_accounts boolean",
    "supplier_invoice_lines": f"unique_id string, supplier_invoice_id bigint, quantity {_D}, price_per_unit {_P}, "
                              f"discount_percentage {_PCT}, discount_amount {_P}, overridden_tax_amount {_P}, "
                              f"tax_code_id int, nominal_code_id bigint, description string",
    "purchase_order_lines": "supplier_invoice_line_id string, supplier_credit_line_id string, part_number string",
    "purchase_order": "unique_id bigint, po_number string, job_auto_id bigint, supplier_id bigint",
    "supplier": "id bigint, account_number string",
    "subcontractor_invoice": "unique_id bigint, purchase_order_id bigint, invoice_number string, type int, "
                             "date timestamp_ntz, passed_to_accounts boolean",
    "subcontractor_invoice_lines": f"unique_id string, subcontractor_invoice_id bigint, quantity {_D}, "
                                   f"price_per_unit {_P}, tax_code_id int, nominal_code_id bigint, "
                                   f"description string",
    "subcontractor_po_lines": "invoice_line_id string, credit_line_id string",
    "subcontractor_po": "unique_id bigint, po_number string, job_auto_id bigint, subcontractor_id bigint",
    "subcontractor": "id bigint, account_number string",
    "jobeng": "job_auto_id bigint",
    "cost": "invoice_line_id string, cost_type_id int, engineer_auto_id bigint",
    "qcost": "invoice_line_id string, cost_type_id int, schedule_of_rates_item_id bigint, stock_item_id bigint",
    "sor_item": "id bigint, code string",
    "stock_part": "stock_item_id bigint, number string",
    "engineer": "auto_last_id bigint",
}

assert set(DDL) == set(SCHEMA), set(DDL) ^ set(SCHEMA)
