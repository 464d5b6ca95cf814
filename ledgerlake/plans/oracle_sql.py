"""DuckDB text of the stand-ins (mirrors :mod:`ledgerlake.plans.standins`)."""

from __future__ import annotations

from ledgerlake.plans.standins import ROLE_GROUP_ROWS


def _lit(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


LINES = """lines AS (
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
                   CAST(l_suppkey AS VARCHAR), CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR)) AS "Line ID",
         CAST(l_orderkey AS VARCHAR) AS "Invoice ID",
         CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS "Role",
         CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' AND l_quantity = 1 THEN NULL
              ELSE ' P' || CAST(l_partkey AS VARCHAR) END AS "Expense Code",
         l_shipdate AS "Line Date",
         l_quantity AS "Quantity",
         CAST(l_extendedprice AS DECIMAL(15,2)) AS "Amount"
  FROM lineitem)"""

EXPENSE_CODES = """expense_codes AS (
  SELECT CASE WHEN p_size = 1 THEN NULL
              ELSE 'P' || CAST(p_partkey AS VARCHAR) || chr(9) END AS "Expense Code",
         p_type AS "Expense Type",
         p_name AS "Expense Name"
  FROM part)"""

#: Stripped codes; of the rows without one the smallest stands for all.
ONE_NULL_CODE = """e0 AS (SELECT * REPLACE (trim("Expense Code", {ws}) AS "Expense Code") FROM expense_codes),
  e AS (SELECT * FROM e0 WHERE "Expense Code" IS NOT NULL
        UNION ALL (SELECT * FROM e0 WHERE "Expense Code" IS NULL ORDER BY "Expense Type", "Expense Name" LIMIT 1))"""

ROLE_GROUPS = (
    'role_groups AS (SELECT * FROM (VALUES '
    + ", ".join(f"({_lit(r)}, {_lit(g)})" for r, g in ROLE_GROUP_ROWS)
    + ') AS t("Role", "Group"))'
)

INVOICES = """invoices AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS "Invoice ID", CAST(o_custkey AS VARCHAR) AS "Matter Ref",
         o_orderdate AS "Invoice Date", o_orderstatus AS "Invoice Status",
         CAST(o_totalprice AS DECIMAL(15,2)) AS "Gross Total", o_orderpriority AS "Priority"
  FROM orders)"""

MATTERS = """matters AS (
  SELECT CAST(c_custkey AS VARCHAR) AS "Matter Ref", c_name AS "Matter", CAST(c_nationkey AS VARCHAR) AS "Country",
         c_mktsegment AS "Department", CAST(c_acctbal AS DECIMAL(15,2)) AS "Budget"
  FROM customer)"""

TIMEKEEPERS = """timekeepers AS (
  SELECT CASE WHEN s_acctbal < 0 THEN NULL ELSE s_name END AS "Timekeeper",
         CAST(s_nationkey AS VARCHAR) AS "Customer MatterID",
         CASE WHEN s_acctbal < 1000 THEN NULL WHEN s_acctbal < 5000 THEN 'A' ELSE 'R' END AS "Role",
         CAST(s_acctbal AS DECIMAL(15,2)) AS "Rate",
         CAST(s_suppkey AS VARCHAR) AS "Timekeeper ID"
  FROM supplier)"""

# Python str.strip() white space, as a DuckDB string expression.
WS = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"

FIRST_LOAD_END = "TIMESTAMP '2000-01-01 00:00:00'"
SECOND_LOAD_START = "TIMESTAMP '1999-01-01 00:00:00'"

INVOICE_LOADS = INVOICES + f""",
first_load AS (SELECT * FROM invoices WHERE "Invoice Date" < {FIRST_LOAD_END}),
second_load AS (
  SELECT "Invoice ID", "Matter Ref", "Invoice Date",
         CASE WHEN "Invoice Date" < {FIRST_LOAD_END} AND "Invoice Status" = 'O' THEN 'F' ELSE "Invoice Status" END AS "Invoice Status",
         "Gross Total",
         CASE WHEN "Invoice Date" < {FIRST_LOAD_END} AND "Priority" = '5-LOW' THEN NULL ELSE "Priority" END AS "Priority"
  FROM invoices WHERE "Invoice Date" >= {SECOND_LOAD_START})"""

LINE_POSITIONS = """line_positions AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS "Invoice ID",
         CASE WHEN l_quantity = 50 THEN NULL ELSE l_linenumber END AS "Line No",
         CAST(l_partkey AS VARCHAR) AS "Part", l_quantity AS "Quantity",
         CAST(l_extendedprice AS DECIMAL(15,2)) AS "Amount", l_linestatus AS "Line Status", l_shipdate AS "Line Date"
  FROM lineitem)"""

LINE_POSITION_LOADS = LINE_POSITIONS + f""",
first_lines AS (SELECT * FROM line_positions WHERE "Line Date" < {FIRST_LOAD_END}),
second_lines AS (
  SELECT * REPLACE (CASE WHEN "Line Date" < {FIRST_LOAD_END} AND "Line Status" = 'O' THEN 'F' ELSE "Line Status" END AS "Line Status")
  FROM line_positions WHERE "Line Date" >= {SECOND_LOAD_START})"""

INVOICE_PAYLOAD = ["Invoice ID", "Matter Ref", "Invoice Date", "Invoice Status", "Gross Total", "Priority"]


def enc(expr: str) -> str:
    """Field encoding of the change hash: <length>:<text>, null as ~."""
    t = f"CAST({expr} AS VARCHAR)"
    return f"coalesce(CAST(length({t}) AS VARCHAR) || ':' || {t}, '~')"


def hash_of(exprs: list[str]) -> str:
    return "sha256(" + " || '|' || ".join(enc(e) for e in exprs) + ")"


def row_id_of(record_type: str, keys: list[str]) -> str:
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return f"CASE WHEN {present} THEN {hash_of([repr(record_type)] + keys)} END"


def q(c: str, alias: str | None = None) -> str:
    return (f'{alias}."{c}"' if alias else f'"{c}"')

SOURCE_SYSTEM = "REPORT_API"

FACT_LINES = """fl AS (
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
                   CAST(l_suppkey AS VARCHAR), CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR)) AS line_id,
         CAST(l_orderkey AS VARCHAR) AS invoice_id, CAST(l_suppkey AS VARCHAR) AS timekeeper_id,
         l_linestatus AS line_type, l_shipdate AS line_date,
         {quantity} AS adjusted_line_quantity,
         CAST(l_extendedprice AS DECIMAL(15,2)) AS adjusted_line_amount, l_returnflag AS role,
         'P' || CAST(l_partkey AS VARCHAR) AS expense_code
  FROM lineitem)"""

FACT_SOURCES = FACT_LINES.format(quantity="CAST(l_quantity AS DECIMAL(5,2))") + """,
fi AS (SELECT CAST(o_orderkey AS VARCHAR) AS invoice_id, CAST(o_custkey AS VARCHAR) AS matter_ref, o_orderdate AS invoice_date,
              o_orderstatus AS invoice_status, CAST(o_totalprice AS DECIMAL(15,2)) AS gross_total,
              o_orderpriority AS invoice_payment_status FROM orders),
fm AS (SELECT CAST(c_custkey AS VARCHAR) AS matter_ref, c_name AS matter, CAST(c_nationkey AS VARCHAR) AS country,
              c_mktsegment AS department, CAST(c_acctbal AS DECIMAL(15,2)) AS budget_in_customer_currency FROM customer),
ft AS (SELECT CAST(s_suppkey AS VARCHAR) AS timekeeper_id, s_name AS timekeeper,
              CAST(s_nationkey AS VARCHAR) AS customer_matter_id FROM supplier)"""


def duck_type(t: str) -> str:
    if t.startswith("decimal"):
        return t.upper()
    return {"varchar": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
            "int": "INTEGER"}[t]


def fact_select(exprs: dict[str, str]) -> str:
    """All 71 fact columns: mapped ones TRY_CAST to the column type, others NULL."""
    from ledgerlake.schemas import FACT_COLUMNS

    out = []
    for name, t, _ in FACT_COLUMNS:
        if name in exprs:
            out.append(f"TRY_CAST({exprs[name]} AS {duck_type(t)}) AS {name}")
        else:
            out.append(f"CAST(NULL AS {duck_type(t)}) AS {name}")
    return ",\n       ".join(out)


def ids(record_type: str, have: set[str]) -> dict[str, str]:
    def rid(rt: str, key: str) -> str:
        return row_id_of(rt, [key]) if key in have else "NULL"
    keys = {"LINE": "line_id", "INVOICE": "invoice_id", "MATTER": "matter_ref", "TIMEKEEPER": "timekeeper_id"}
    return {
        "fact_guid": rid(record_type, keys[record_type]),
        "fact_matter_guid": rid("MATTER", "matter_ref"),
        "fact_matter_invoice_guid": rid("INVOICE", "invoice_id"),
        "fact_invoice_lineitem_guid": rid("LINE", "line_id"),
        "record_type": f"'{record_type}'",
        "source_system_cde": f"'{SOURCE_SYSTEM}'",
    }
