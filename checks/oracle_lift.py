"""The test-table lift (FIXTURES.md §3) written in DuckDB SQL.

Independent of ``tallybook.sources.lift`` (which is DataFrame code); the two
must describe the same tables. Canonical tables carry a ``t_`` prefix so they
never shadow the driver's views (``customer``, ``part`` ...).
"""

LIFT_CTES: list[tuple[str, str]] = [
    ("t_base_invoice", """
select o_orderkey as unique_id, o_orderkey as auto_id, concat('INV', cast(o_orderkey as varchar)) as id,
       (o_orderkey % 10 = 9) as credit_note,
       case when o_orderkey % 10 = 9 then o_orderkey - 8 end as credited_invoice_guid,
       (o_orderstatus = 'P' and o_orderkey % 5 = 0) as is_draft,
       (o_orderpriority = '5-LOW') as passed_to_accounts, o_orderdate as date,
       case when o_orderkey % 4 <> 0 then concat('PO', cast(o_orderkey % 1000 as varchar)) end as order_no,
       case when o_custkey % 9 <> 0 then concat('AC', cast(o_custkey as varchar)) end as account_number,
       concat('Head ', cast(o_custkey as varchar)) as name, concat(cast(o_orderkey as varchar), ' High Street') as address1,
       o_orderpriority as address2, case when o_custkey % 2 = 0 then o_orderstatus end as address3,
       concat('Town ', cast(o_custkey % 40 as varchar)) as address4, concat('PC', cast(o_custkey as varchar)) as postcode,
       case when o_orderkey % 10 = 9 then concat('reason ', o_orderstatus) end as reason
from orders"""),
    ("t_invoice", "select o_orderkey as unique_id, o_orderkey as job_auto_id, o_custkey // 15 as user_id "
                  "from orders where o_orderkey % 3 = 0"),
    ("t_job", """
select o_orderkey as auto_id, concat('J', cast(o_orderkey as varchar)) as id,
       case when o_custkey % 20 <> 0 then o_custkey end as customer_auto_id, o_custkey % 25 as site_auto_id,
       o_orderpriority as description
from orders where o_orderkey % 30 <> 0"""),
    ("t_ppm_invoices", "select o_orderkey as unique_id, o_orderkey - o_orderkey % 20 as ppm_contract_id "
                       "from orders where o_orderkey % 3 = 1"),
    ("t_ppm_contract", """
select o_orderkey as unique_id, concat('PPM', cast(o_orderkey as varchar)) as ppm_contract_number,
       concat('contract of ', o_orderpriority) as description, o_custkey as customer_auto_id, o_custkey % 25 as site_auto_id
from orders where o_orderkey % 20 = 0 and o_orderkey % 140 <> 0"""),
    ("t_cg_invoice", "select o_orderkey as unique_id, case when o_custkey % 20 <> 0 then o_custkey end as "
                     "customer_auto_id from orders where o_orderkey % 3 = 2"),
    ("fx_line", """
select concat_ws('-', cast(l_orderkey as varchar), cast(l_linenumber as varchar), cast(l_partkey as varchar),
                 cast(l_suppkey as varchar), cast(cast(round(l_extendedprice * 100) as bigint) as varchar)) as line_uid,
       l_orderkey as invoice_guid, l_linenumber as line_no,
       case l_orderkey % 3 when 0 then 'S' when 1 then 'P' else 'C' end as kind,
       cast(l_quantity as decimal(9,2)) as qty,
       cast(case when l_linenumber in (6, 7) then 0 else l_extendedprice end as decimal(12,2)) as price,
       cast(case l_linenumber when 3 then 5.00 when 6 then 25.00 end as decimal(12,2)) as discount_amount,
       cast(case when l_linenumber in (2, 7) then l_discount * 100 + cast(0.3333 as double) end as decimal(7,4)) as discount_percentage,
       case when l_tax > 0 then cast(round(l_tax * 100) as int) end as tax_code_id,
       l_partkey as nominal_code_id,
       concat('part ', cast(l_partkey as varchar), ' supplied by ', cast(l_suppkey as varchar), ' flag ',
              l_returnflag, l_linestatus) as details,
       l_shipdate as created_at, l_returnflag, l_linestatus, l_partkey, l_suppkey
from lineitem"""),
    ("t_invdets", """
select line_uid as unique_id, line_uid as auto_id, invoice_guid, qty, price, discount_amount, discount_percentage,
       tax_code_id, nominal_code_id, details,
       case when invoice_guid % 10 = 9 then line_uid end as credited_invoice_line_id, created_at
from fx_line where kind = 'S'"""),
    ("t_ppm_lines", """
select line_uid as unique_id, invoice_guid as invoice_id, qty as quantity, price as price_per_unit, discount_amount,
       discount_percentage, tax_code_id, nominal_code_id, details as description, created_at
from fx_line where kind = 'P'"""),
    ("t_cg_lines", """
select line_uid as unique_id, invoice_guid, qty, price, discount_amount, discount_percentage, tax_code_id,
       nominal_code_id, details, invoice_guid as job_auto_id, case when invoice_guid % 10 = 9 then line_uid end as credited_invoice_line_guid,
       created_at
from fx_line where kind = 'C'"""),
    ("t_tax_codes", """
select tax_code_id as unique_id, concat('T', cast(tax_code_id as varchar)) as code,
       cast(tax_code_id + case when tax_code_id % 4 = 1 then 0.555 else 0 end as decimal(6,3)) as value, concat('Rate ', cast(tax_code_id as varchar)) as description
from (select distinct tax_code_id from fx_line where tax_code_id is not null and tax_code_id <> 3)"""),
    ("t_nominal_codes", "select p_partkey as unique_id, p_brand as code from part where p_partkey % 7 <> 0"),
    ("fx_pay", """
select event_id // 4 * 6 + case event_id % 4 when 0 then 0 when 1 then 1 else 5 end as invoice_guid,
       case when event_type <> 'error' then cast(value as decimal(12,2)) end as amount, event_type
from events where event_type <> 'click'"""),
    ("t_invoice_payments", "select invoice_guid, amount from fx_pay where event_type in ('purchase', 'error')"),
    ("t_ppm_payments", "select invoice_guid as ppm_contract_invoice_id, amount from fx_pay where event_type = 'signup'"),
    ("t_cg_payments", "select invoice_guid, amount from fx_pay where event_type = 'view'"),
    ("t_jobeng", "select event_id // 4 * 6 + event_id % 2 * 3 as job_auto_id from events where event_type = 'click'"),
    ("t_customer", """
select c_custkey as auto_last_id, c_custkey as unique_id, concat('CUST', cast(c_custkey as varchar)) as id,
       c_name as name, concat(cast(c_custkey as varchar), ' Low Road') as address1, concat('Unit ', cast(c_nationkey as varchar)) as address2,
       case when c_custkey % 2 = 1 then c_mktsegment end as address3, concat('County ', cast(c_nationkey as varchar)) as address4,
       concat('Z', cast(c_custkey as varchar)) as postcode, case when c_custkey % 3 <> 0 then concat('ref ', c_name) end as custom_reference,
       c_mktsegment as contact, concat('0', cast(1000000 + c_custkey as varchar)) as telephone,
       concat('c', cast(c_custkey as varchar), '@example.org') as email_address,
       case when c_custkey % 4 <> 0 then concat('VAT', cast(c_custkey as varchar)) end as vat_number,
       case c_custkey % 3 when 0 then '' when 1 then concat('A', cast(c_custkey as varchar)) end as account_number,
       (c_custkey % 2 = 0) as warning1_used, case when c_custkey % 2 = 0 then concat('first ', c_mktsegment) end as warning1_comments,
       case when c_custkey % 3 <> 0 then (c_custkey % 3 = 1) end as warning2_used, concat('second ', c_name) as warning2_comments,
       (c_acctbal > 5000) as warning3_used, case when c_acctbal > 5000 then 'third' end as warning3_comments,
       (c_acctbal < 0) as inactive,
       case c_custkey % 10 when 0 then null when 1 then ''
            else concat_ws(',', cast(c_nationkey as varchar), cast(c_custkey % 25 as varchar)) end as job_type_ids,
       case c_custkey % 8 when 0 then null when 1 then ''
            else concat_ws(',', cast(c_custkey % 19 as varchar), cast((c_custkey + 5) % 23 as varchar)) end
            as job_category_ids,
       c_mktsegment as job_type_category_description,
       case when c_custkey % 4 <> 0 then (c_custkey % 4 = 1) end as impact_job_priority,
       case when c_custkey % 5 <> 0 then (c_custkey % 5 > 2) end as show_in_bo,
       case when c_custkey % 6 <> 0 then (c_custkey % 6 > 3) end as show_in_portal,
       case when c_custkey % 7 <> 0 then (c_custkey % 7 > 4) end as show_in_mobile,
       c_custkey % 6 as cust_type_id, c_custkey % 4 as selling_rate_id, c_nationkey as account_manager_id,
       c_nationkey % 5 as fc_library_auto_id
from customer"""),
    ("t_contract", """
select n_nationkey as auto_id, concat('SITE', cast(n_nationkey as varchar)) as id, n_name as site,
       case when n_nationkey % 2 = 0 then concat('S', cast(n_nationkey as varchar))
            when n_nationkey % 3 = 0 then ' ' end as account_number
from nation"""),
    ("t_jobctl", "select n_nationkey as auto_id, n_name as description from nation where n_nationkey between 1 and 19"),
    ("t_job_category", "select auto_id, description from t_jobctl"),
    ("t_tag", "select r_regionkey as unique_id, r_name as title from region"),
    ("t_tag_level", """
select c_custkey as level_id, c_custkey % 6 as tag_id, 1 + c_custkey % 2 as entity_type from customer
union all
select c_custkey, (c_custkey + 1) % 6, 1 from customer where c_custkey % 3 = 0"""),
    ("t_customer_types", "select r_regionkey as cust_type_id, r_name as description from region"),
    ("t_selling_rates", "select r_regionkey as id, concat('Rate ', r_name) as description from region "
                        "where r_regionkey < 3"),
    ("t_fault_code_library", "select r_regionkey as auto_id, concat('FCL ', r_name) as description from region"),
    ("t_sor_library", "select n_nationkey as id, concat('SOR ', n_name) as description from nation"),
    ("t_sor_link", """
select c_custkey as customer_id, c_nationkey as library_id, (c_custkey % 2 = 0) as is_default,
       cast(case when c_custkey % 3 = 0 then c_nationkey end as decimal(9,2)) as uplift,
       cast(case when c_custkey % 3 = 1 then c_nationkey end as decimal(9,2)) as discount
from customer"""),
    ("t_users", "select s_suppkey as user_id, s_name as full_name, s_suppkey as engineer_id, s_name as reference "
                "from supplier"),
    ("t_engineer", "select s_suppkey as auto_last_id from supplier"),
    ("t_cost", """
select line_uid as invoice_line_id, case when l_linestatus = 'F' then 5 else 9 end as cost_type_id,
       l_suppkey as engineer_auto_id
from fx_line where l_returnflag = 'A'"""),
    ("t_qcost", """
select line_uid as invoice_line_id, case when l_linestatus = 'F' then 9 else 5 end as cost_type_id,
       l_partkey as schedule_of_rates_item_id, l_partkey as stock_item_id
from fx_line where l_returnflag in ('A', 'N')"""),
    ("t_sor_item", "select p_partkey as id, concat('SR', cast(p_partkey as varchar)) as code from part "
                   "where p_partkey % 3 <> 0"),
    ("t_stock_part", "select p_partkey as stock_item_id, concat('PN', cast(p_partkey as varchar)) as number "
                     "from part where p_partkey % 4 <> 0"),
    ("t_control", "select 'Europe/London' as timezone from region where r_regionkey = 0"),
    ("fx_pinv", """
select o_orderkey as unique_id, (o_orderkey % 2 = 0) as is_supplier,
       case when o_orderkey % 10 in (4, 9) then 1 when o_orderkey % 50 in (8, 13) then 2 else 0 end as type,
       concat('PI', cast(o_orderkey as varchar)) as invoice_number, o_orderdate as date,
       (o_orderpriority = '5-LOW') as passed_to_accounts, o_orderkey as job_auto_id, o_custkey // 12 as party_id,
       concat('PON', cast(o_orderkey as varchar)) as po_number
from orders"""),
    ("t_supplier_invoice", "select unique_id, unique_id as purchase_order_id, invoice_number, type, date, "
                           "passed_to_accounts from fx_pinv where is_supplier"),
    ("t_subcontractor_invoice", "select unique_id, unique_id as purchase_order_id, invoice_number, type, date, "
                                "passed_to_accounts from fx_pinv where not is_supplier"),
    ("t_purchase_order", "select unique_id, po_number, job_auto_id, party_id as supplier_id from fx_pinv "
                         "where is_supplier"),
    ("t_subcontractor_po", "select unique_id, po_number, job_auto_id, party_id as subcontractor_id from fx_pinv "
                           "where not is_supplier"),
    ("t_supplier", "select s_suppkey as id, concat('SUP', cast(s_suppkey as varchar)) as account_number "
                   "from supplier"),
    ("t_subcontractor", "select s_suppkey as id, concat('SUB', cast(s_suppkey as varchar)) as account_number "
                        "from supplier where s_suppkey % 2 = 0"),
    ("fx_pline", """
select line_uid, invoice_guid as invoice_id, qty as quantity, price as price_per_unit,
       case when line_no = 2 then discount_percentage end as discount_percentage,
       case when line_no = 3 then discount_amount end as discount_amount,
       cast(case when line_no = 5 then 3.33 end as decimal(12,2)) as overridden_tax_amount,
       tax_code_id, nominal_code_id, details as description
from fx_line"""),
    ("t_supplier_invoice_lines", """
select line_uid as unique_id, invoice_id as supplier_invoice_id, quantity, price_per_unit, discount_percentage,
       discount_amount, overridden_tax_amount, tax_code_id, nominal_code_id, description
from fx_pline where invoice_id % 2 = 0"""),
    ("t_subcontractor_invoice_lines", """
select line_uid as unique_id, invoice_id as subcontractor_invoice_id, quantity, price_per_unit, tax_code_id,
       nominal_code_id, description
from fx_pline where invoice_id % 2 = 1"""),
    ("fx_po_line", """
select case when l_returnflag <> 'R' then line_uid end as invoice_line_id,
       case when l_linestatus = 'F' then line_uid end as credit_line_id,
       concat('P', cast(l_partkey as varchar)) as part_number
from fx_line"""),
    ("t_purchase_order_lines", "select invoice_line_id as supplier_invoice_line_id, credit_line_id as "
                               "supplier_credit_line_id, part_number from fx_po_line"),
    ("t_subcontractor_po_lines", "select invoice_line_id, credit_line_id from fx_po_line"),
]
