"""Schemas and fixed values.

Everything in the block marked FIXED VALUES must equal what the source
system uses (column names, lengths, report names, page size); the rest of
the package derives from it.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES — must match the source system exactly.
# ---------------------------------------------------------------------------

# Rows on a full report page; a page of exactly this size means "more follow".
PAGE_SIZE = 5000

# Length of the rolling report window, in weeks.
WINDOW_WEEKS = 12

# Currencies the report service documents; the loader asks for USD.
CURRENCIES = ("EUR", "USD", "GBP", "AUD")
DEFAULT_CURRENCY = "USD"
REPORT_LAYOUT = "FLATTENED"

# Report name -> (target table, key columns).
REPORTS = {
    "Reporting API - Invoice Level": ("invoice_level", ("Invoice ID",)),
    "Reporting API - matter report": ("matter_report", ("Matter Ref",)),
    "Reporting API - test report": ("test_report", ("Line ID",)),
    "Timekeeper Report - full data pull down": ("timekeeper_report", ("Timekeeper", "Customer MatterID")),
}

# Default written into a missing line-item role.
ROLE_DEFAULT = "Not Specified"

# Versioned fact: (column, type, max bytes for strings) in table order.
FACT_COLUMNS = [
    ("fact_guid", "varchar", 64),
    ("fact_matter_guid", "varchar", 64),
    ("fact_matter_invoice_guid", "varchar", 64),
    ("fact_invoice_lineitem_guid", "varchar", 64),
    ("matter_ref", "varchar", 50),
    ("matter", "varchar", 2000),
    ("customer_matter_id", "varchar", 50),
    ("department", "varchar", 500),
    ("matter_vendors", "varchar", 5000),
    ("internal_matter_lead_name", "varchar", 500),
    ("no_of_days_since_last_invoice_uploaded", "varchar", 50),
    ("budget_in_customer_currency", "decimal(15,2)", None),
    ("average_blended_rate", "decimal(15,2)", None),
    ("no_of_invoice", "decimal(5,0)", None),
    ("duration_in_days", "decimal(10,0)", None),
    ("no_of_timekeepers", "decimal(5,0)", None),
    ("country", "varchar", 500),
    ("region", "varchar", 50),
    ("fee_type", "varchar", 500),
    ("matter_expense_activity", "varchar", 1000),
    ("matter_open_date", "timestamp_ntz", None),
    ("matter_close_date", "timestamp_ntz", None),
    ("timekeeper_description", "varchar", 2000),
    ("invoice_id", "varchar", 2000),
    ("purchase_order_number", "varchar", 2000),
    ("invoice_number", "varchar", 2000),
    ("invoice_payment_status", "varchar", 2000),
    ("matter_category", "varchar", 2000),
    ("entity", "varchar", 2000),
    ("invoice_date", "timestamp_ntz", None),
    ("tax", "decimal(15,2)", None),
    ("discount", "decimal(15,2)", None),
    ("total_expenses", "decimal(15,2)", None),
    ("net_fees_total", "decimal(15,2)", None),
    ("gross_total", "decimal(15,2)", None),
    ("invoice_vendor", "varchar", 2000),
    ("billing_period_start_date", "timestamp_ntz", None),
    ("billing_period_end_date", "timestamp_ntz", None),
    ("line_id", "varchar", 50),
    ("line_type", "varchar", 100),
    ("line_date", "timestamp_ntz", None),
    ("adjusted_line_quantity", "decimal(5,2)", None),
    ("line_unit_cost", "decimal(15,2)", None),
    ("adjusted_line_unit_cost", "decimal(15,2)", None),
    ("adjusted_line_amount", "decimal(15,2)", None),
    ("timekeeper_id", "varchar", 50),
    ("timekeeper", "varchar", 2000),
    ("role", "varchar", 50),
    ("role_group", "varchar", 50),
    ("line_invoice_date", "timestamp_ntz", None),
    ("matter_id", "varchar", 50),
    ("invoice_status", "varchar", 50),
    ("billing_start_date", "timestamp_ntz", None),
    ("billing_end_date", "timestamp_ntz", None),
    ("expense_code", "varchar", 50),
    ("line_expense_activity", "varchar", 1000),
    ("activity_code", "varchar", 2000),
    ("vendor_ref", "varchar", 2000),
    ("mio_delete_ind", "varchar", 2),
    ("record_type", "varchar", 256),
    ("source_system_cde", "varchar", 50),
    ("mio_current_status", "boolean", None),
    ("mio_version_number", "int", None),
    ("mio_created_by", "varchar", 2000),
    ("mio_create_date_time", "timestamp_ntz", None),
    ("mio_updated_by", "varchar", 2000),
    ("mio_update_date_time", "timestamp_ntz", None),
    ("mio_source_filename", "varchar", 2000),
    ("mio_delta_hash", "varchar", 5000),
    ("mio_version_valid_from", "date", None),
    ("mio_version_valid_to", "date", None),
]

# Marker of a logically deleted row (full refresh).
DELETE_MARK = "Y"

# ---------------------------------------------------------------------------
# Values fixed by public library behaviour that the cleaning rules reproduce.
# ---------------------------------------------------------------------------

# Strings that the pandas CSV reader turns into a missing value by default.
NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Characters that Python's str.strip() removes (Unicode white space).
WHITESPACE = "".join(
    chr(c) for c in list(range(0x09, 0x0E)) + list(range(0x1C, 0x21))
    + [0x85, 0xA0, 0x1680] + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)

# ---------------------------------------------------------------------------
# Derived Spark schemas.
# ---------------------------------------------------------------------------


def _spark_type(name: str) -> T.DataType:
    if name == "varchar":
        return T.StringType()
    if name.startswith("decimal"):
        p, s = name[len("decimal("):-1].split(",")
        return T.DecimalType(int(p), int(s))
    return {
        "timestamp_ntz": T.TimestampNTZType(),
        "date": T.DateType(),
        "boolean": T.BooleanType(),
        "int": T.IntegerType(),
    }[name]


FACT_SCHEMA = T.StructType([T.StructField(n, _spark_type(t), True) for n, t, _ in FACT_COLUMNS])
FACT_NAMES = [n for n, _, _ in FACT_COLUMNS]
FACT_MAX_BYTES = {n: b for n, _, b in FACT_COLUMNS if b is not None}


def is_payload_column(name: str) -> bool:
    """Payload = neither a bookkeeping column (mio_*) nor an id (*_guid)."""
    return not name.startswith("mio_") and not name.endswith("_guid")


FACT_PAYLOAD = [n for n in FACT_NAMES if is_payload_column(n)]

# Lookup files: every column is read as text; types are never inferred.
ROLE_GROUPS_SCHEMA = T.StructType([
    T.StructField("Role", T.StringType()),
    T.StructField("Group", T.StringType()),
])
