"""The invoice model: the base tables the reports read, as DataFrames.

Names are snake_case versions of the source tables; column names likewise
(``InvoiceGuid`` -> ``invoice_guid``). Ids that are GUIDs in the source system
are compared without regard to case: :func:`ingest` writes them in lower case once,
beside the stored text of those that reports show.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType, StringType

from tallybook.session import checkpoint_dir

# Table name -> columns the reports read. This is the whole input contract.
SCHEMA: dict[str, tuple[str, ...]] = {
    "base_invoice": ("unique_id", "auto_id", "id", "credit_note", "credited_invoice_guid", "is_draft",
                     "passed_to_accounts", "date", "order_no", "account_number", "name", "address1",
                     "address2", "address3", "address4", "postcode", "reason"),
    "invoice": ("unique_id", "job_auto_id", "user_id"),
    "invdets": ("unique_id", "auto_id", "invoice_guid", "qty", "price", "discount_amount",
                "discount_percentage", "tax_code_id", "nominal_code_id", "details",
                "credited_invoice_line_id", "created_at"),
    "ppm_invoices": ("unique_id", "ppm_contract_id"),
    "ppm_lines": ("unique_id", "invoice_id", "quantity", "price_per_unit", "discount_amount",
                  "discount_percentage", "tax_code_id", "nominal_code_id", "description", "created_at"),
    "ppm_contract": ("unique_id", "ppm_contract_number", "description", "customer_auto_id", "site_auto_id"),
    "cg_invoice": ("unique_id", "customer_auto_id"),
    "cg_lines": ("unique_id", "invoice_guid", "qty", "price", "discount_amount", "discount_percentage",
                 "tax_code_id", "nominal_code_id", "details", "job_auto_id", "credited_invoice_line_guid",
                 "created_at"),
    "invoice_payments": ("invoice_guid", "amount"),
    "ppm_payments": ("ppm_contract_invoice_id", "amount"),
    "cg_payments": ("invoice_guid", "amount"),
    "tax_codes": ("unique_id", "code", "value", "description"),
    "nominal_codes": ("unique_id", "code"),
    "job": ("auto_id", "id", "customer_auto_id", "site_auto_id", "description"),
    "customer": ("auto_last_id", "unique_id", "id", "name", "address1", "address2", "address3", "address4",
                 "postcode", "custom_reference", "contact", "telephone", "email_address", "vat_number",
                 "account_number", "warning1_used", "warning1_comments", "warning2_used", "warning2_comments",
                 "warning3_used", "warning3_comments", "inactive", "job_type_ids", "job_category_ids",
                 "job_type_category_description", "impact_job_priority", "show_in_bo", "show_in_portal",
                 "show_in_mobile", "cust_type_id", "selling_rate_id", "account_manager_id",
                 "fc_library_auto_id"),
    "contract": ("auto_id", "id", "site", "account_number"),
    "tag_level": ("level_id", "tag_id", "entity_type"),
    "tag": ("unique_id", "title"),
    "jobctl": ("auto_id", "description"),
    "job_category": ("auto_id", "description"),
    "customer_types": ("cust_type_id", "description"),
    "selling_rates": ("id", "description"),
    "users": ("user_id", "full_name", "engineer_id", "reference"),
    "sor_link": ("customer_id", "library_id", "is_default", "uplift", "discount"),
    "sor_library": ("id", "description"),
    "fault_code_library": ("auto_id", "description"),
    "control": ("timezone",),
    "supplier_invoice": ("unique_id", "purchase_order_id", "invoice_number", "type", "date",
                         "passed_to_accounts"),
    "supplier_invoice_lines": ("unique_id", "supplier_invoice_id", "quantity", "price_per_unit",
                               "discount_percentage", "discount_amount", "overridden_tax_amount",
                               "tax_code_id", "nominal_code_id", "description"),
    "purchase_order_lines": ("supplier_invoice_line_id", "supplier_credit_line_id", "part_number"),
    "purchase_order": ("unique_id", "po_number", "job_auto_id", "supplier_id"),
    "supplier": ("id", "account_number"),
    "subcontractor_invoice": ("unique_id", "purchase_order_id", "invoice_number", "type", "date",
                              "passed_to_accounts"),
    "subcontractor_invoice_lines": ("unique_id", "subcontractor_invoice_id", "quantity", "price_per_unit",
                                    "tax_code_id", "nominal_code_id", "description"),
    "subcontractor_po_lines": ("invoice_line_id", "credit_line_id"),
    "subcontractor_po": ("unique_id", "po_number", "job_auto_id", "subcontractor_id"),
    "subcontractor": ("id", "account_number"),
    "jobeng": ("job_auto_id",),
    "cost": ("invoice_line_id", "cost_type_id", "engineer_auto_id"),
    "qcost": ("invoice_line_id", "cost_type_id", "schedule_of_rates_item_id", "stock_item_id"),
    "sor_item": ("id", "code"),
    "stock_part": ("stock_item_id", "number"),
    "engineer": ("auto_last_id",),
}


@dataclass
class InvoiceModel:
    base_invoice: DataFrame
    invoice: DataFrame
    invdets: DataFrame
    ppm_invoices: DataFrame
    ppm_lines: DataFrame
    ppm_contract: DataFrame
    cg_invoice: DataFrame
    cg_lines: DataFrame
    invoice_payments: DataFrame
    ppm_payments: DataFrame
    cg_payments: DataFrame
    tax_codes: DataFrame
    nominal_codes: DataFrame
    job: DataFrame
    customer: DataFrame
    contract: DataFrame
    tag_level: DataFrame
    tag: DataFrame
    jobctl: DataFrame
    job_category: DataFrame
    customer_types: DataFrame
    selling_rates: DataFrame
    users: DataFrame
    sor_link: DataFrame
    sor_library: DataFrame
    fault_code_library: DataFrame
    control: DataFrame
    supplier_invoice: DataFrame
    supplier_invoice_lines: DataFrame
    purchase_order_lines: DataFrame
    purchase_order: DataFrame
    supplier: DataFrame
    subcontractor_invoice: DataFrame
    subcontractor_invoice_lines: DataFrame
    subcontractor_po_lines: DataFrame
    subcontractor_po: DataFrame
    subcontractor: DataFrame
    jobeng: DataFrame
    cost: DataFrame
    qcost: DataFrame
    sor_item: DataFrame
    stock_part: DataFrame
    engineer: DataFrame

    def check(self) -> "InvoiceModel":
        """Fail early if a table lacks a column the reports read."""
        for f in fields(self):
            have = set(getattr(self, f.name).columns)
            missing = [c for c in SCHEMA[f.name] if c not in have]
            if missing:
                raise ValueError(f"table {f.name} lacks columns {missing}")
            for c in getattr(self, f.name).select(*SCHEMA[f.name]).schema.fields:
                most = 6 if (f.name, c.name) == ("tax_codes", "value") else PLACES.get(c.name)
                if most is not None and not (isinstance(c.dataType, DecimalType) and c.dataType.scale <= most or isinstance(c.dataType, IntegralType)):
                    raise ValueError(f"{f.name}.{c.name} must be a decimal of at most {most} decimal places, not {c.dataType.simpleString()}")
        return self


# Decimal places up to which the valuation rules are exact.
PLACES = {"qty": 4, "quantity": 4, "price": 4, "price_per_unit": 4, "discount_amount": 4, "overridden_tax_amount": 4,
          "amount": 4, "discount_percentage": 6}


# Per table, the columns that hold GUID keys in the source
# system (compared case-insensitively there). When stored as text they are
# lower-cased once at load, so every join on them is a plain equi-join.
# Integer identity ids (auto ids, cost-line references) are not listed.
GUID_COLUMNS: dict[str, tuple[str, ...]] = {
    "base_invoice": ("unique_id", "credited_invoice_guid"),
    "invoice": ("unique_id",),
    "invdets": ("unique_id", "invoice_guid", "tax_code_id", "nominal_code_id"),
    "ppm_invoices": ("unique_id", "ppm_contract_id"),
    "ppm_lines": ("unique_id", "invoice_id", "tax_code_id", "nominal_code_id"),
    "ppm_contract": ("unique_id",),
    "cg_invoice": ("unique_id",),
    "cg_lines": ("unique_id", "invoice_guid", "tax_code_id", "nominal_code_id", "credited_invoice_line_guid"),
    "invoice_payments": ("invoice_guid",),
    "ppm_payments": ("ppm_contract_invoice_id",),
    "cg_payments": ("invoice_guid",),
    "tax_codes": ("unique_id",),
    "nominal_codes": ("unique_id",),
    "customer": ("unique_id",),
    "tag_level": ("level_id", "tag_id"),
    "tag": ("unique_id",),
    "supplier_invoice": ("unique_id", "purchase_order_id"),
    "supplier_invoice_lines": ("unique_id", "supplier_invoice_id", "tax_code_id", "nominal_code_id"),
    "purchase_order_lines": ("supplier_invoice_line_id", "supplier_credit_line_id"),
    "purchase_order": ("unique_id",),
    "subcontractor_invoice": ("unique_id", "purchase_order_id"),
    "subcontractor_invoice_lines": ("unique_id", "subcontractor_invoice_id", "tax_code_id", "nominal_code_id"),
    "subcontractor_po_lines": ("invoice_line_id", "credit_line_id"),
    "subcontractor_po": ("unique_id",),
}


#: The GUID keys that reports show as they are stored. Their text lies beside the key, in ``<column>_text``.
REPORTED_GUIDS: dict[str, tuple[str, ...]] = {
    "base_invoice": ("unique_id",), "supplier_invoice": ("unique_id",), "subcontractor_invoice": ("unique_id",)}


def stored(df: DataFrame, key: str) -> Column:
    """A key of a model table as it is stored, for display."""
    return F.col(f"{key}_text" if f"{key}_text" in df.columns else key)


def from_parquet(spark: SparkSession, root: str, normalise_guids: bool | None = None) -> InvoiceModel:
    """Read the model from ``<root>/<table>.parquet`` (one folder or file per table).

    Only the columns in :data:`SCHEMA` (and the stored text of :data:`REPORTED_GUIDS`) are selected, so scans read no more.
    A folder that :func:`ingest` wrote is read as it is. Of any other, text GUID keys (:data:`GUID_COLUMNS`) are lower-cased at the
    scan; numeric ids are left as they are. ``normalise_guids`` says which, if it is given.
    """
    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
    if normalise_guids is None:
        normalise_guids = "unique_id_text" not in read("base_invoice").columns
    return _model(read, normalise_guids)


def ingest(spark: SparkSession, source: str, target: str, files_per_table: int | None = None) -> InvoiceModel:
    """Write the raw tables under ``source`` with canonical keys under ``target`` and return the model that reads them:
    joins there compare plain columns, scans hold no expression on a key, so that filters and runtime filters on keys reach the files."""
    write_model(from_parquet(spark, source, normalise_guids=True), target, files_per_table)
    return from_parquet(spark, target, normalise_guids=False)


def from_catalog(spark: SparkSession, schema: str, normalise_guids: bool = True) -> InvoiceModel:
    """The same from the tables ``<schema>.<table>`` of the session's catalogs; ``schema`` may have a catalog's name before it."""
    return _model(lambda name: spark.table(f"{schema}.{name}"), normalise_guids)


def catalog_tables(spark: SparkSession, schema: str, names: Sequence[str], normalise_guids: bool = True) -> dict[str, DataFrame]:
    """Only the tables ``names`` of a schema, as :func:`from_catalog` reads them: for ``dataclasses.replace`` on a model."""
    return {name: _read(name, spark.table(f"{schema}.{name}"), normalise_guids) for name in names}


def publish(m: InvoiceModel, schema: str, names: Sequence[str] | None = None) -> None:
    """Write the model's tables (``names`` of them) as tables of ``schema``, which is made under the shared folder of
    ``spark.checkpoint.dir`` if it isn't there. Tables of these names are replaced."""
    spark = m.base_invoice.sparkSession
    root = checkpoint_dir(spark).rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{root}/{schema.replace('.', '-')}.db'")
    for name in names or SCHEMA:
        getattr(m, name).write.mode("overwrite").saveAsTable(f"{schema}.{name}")


def _read(name: str, df: DataFrame, normalise_guids: bool) -> DataFrame:
    cols = SCHEMA[name]
    shown = [c for c in REPORTED_GUIDS.get(name, ()) if f"{c}_text" in df.columns]
    df = df.select(*cols, *[f"{c}_text" for c in shown])
    if normalise_guids:
        text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
        guids = set(GUID_COLUMNS.get(name, ())) & text
        new = [c for c in REPORTED_GUIDS.get(name, ()) if c in guids and c not in shown]
        df = df.select(*[F.lower(F.col(c)).alias(c) if c in guids else F.col(c) for c in cols], *[f"{c}_text" for c in shown],
                       *[F.col(c).alias(f"{c}_text") for c in new])
    return df


def _model(read: Callable[[str], DataFrame], normalise_guids: bool) -> InvoiceModel:
    return InvoiceModel(**{name: _read(name, read(name), normalise_guids) for name in SCHEMA}).check()


def write_model(m: InvoiceModel, root: str, files_per_table: int | None = None) -> None:
    """Write every table of ``m`` to ``<root>/<table>.parquet``.

    ``root`` must be shared storage on a cluster (e.g. under the folder named
    by ``spark.checkpoint.dir``). A table is spread over
    ``files_per_table`` files if that is given (small sources of one file);
    otherwise its partitions are written as they are, without a shuffle.
    """
    for f in fields(m):
        df = getattr(m, f.name)
        (df.repartition(files_per_table) if files_per_table else df).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{f.name}.parquet")
