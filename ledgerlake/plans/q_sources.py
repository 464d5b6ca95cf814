"""Queries: landed pages, page-chain audit, look-up files, report windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.text import iso_millis
from ledgerlake.plans import oracle_sql as o
from ledgerlake.plans.q_clean import REPORT_LINE_SQL
from ledgerlake.plans import standins as s
from ledgerlake.plans.catalog import register
from ledgerlake.schemas import REPORTS
from ledgerlake.session import scratch_path
from ledgerlake.sources import lookups as lk
from ledgerlake.sources import pages as pg
from ledgerlake.sources import windows as win

LINE_REPORT = next(name for name, (table, _) in REPORTS.items() if table == "test_report")
WINDOW_END = "2001-06-01 00:00:00"
FIXED_START = "1999-11-01 00:00:00"
#: Codec of landed page files: their text repeats every column name in every record.
LANDED = "gzip"


def _line_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.invoice_pages(s.line_items(spark, sf_dir), LINE_REPORT)


@register("page_ingest", o.with_(o.LINES) + f"""
SELECT '{LINE_REPORT}' AS report, *, 'USD' AS currency, 'FLATTENED' AS report_layout FROM lines""")
def page_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the line-item report as JSON pages, read them back, flatten."""
    pages = _line_pages(spark, sf_dir)
    record_schema = pages.schema["resultSet"].dataType.elementType
    path = scratch_path(spark, "pages")
    pages.write.partitionBy("report").json(path)
    landed = pg.read_pages(spark, path, record_schema)
    return pg.page_rows(landed, "USD").select("report", *record_schema.names, "currency", "report_layout")


@register("page_union", o.with_(o.INVOICES) + """
SELECT "Invoice ID", "Matter Ref", "Gross Total", NULL::TIMESTAMP AS "Invoice Date", NULL::VARCHAR AS "Priority"
FROM invoices WHERE "Invoice Status" = 'F'
UNION ALL
SELECT "Invoice ID", NULL::VARCHAR AS "Matter Ref", NULL::DECIMAL(15,2) AS "Gross Total", "Invoice Date", "Priority"
FROM invoices WHERE "Invoice Status" <> 'F'""")
def page_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of one report that carry different columns stack by name."""
    inv = s.invoices(spark, sf_dir)
    a = inv.filter(F.col("Invoice Status") == "F").select("Invoice ID", "Matter Ref", "Gross Total")
    b = inv.filter(F.col("Invoice Status") != "F").select("Invoice ID", "Invoice Date", "Priority")
    return pg.union_pages([a, b])


AUDIT_SQL = f"""
WITH pages AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS session, CAST(l_linenumber AS BIGINT) AS page, CAST(count(*) AS BIGINT) AS n
  FROM lineitem GROUP BY l_orderkey, l_linenumber, l_linestatus),
linked AS (
  SELECT p.*, EXISTS (SELECT 1 FROM pages q WHERE q.session = p.session AND q.page = p.page + 1) AS has_next,
         EXISTS (SELECT 1 FROM pages q WHERE q.session = p.session AND q.page = p.page - 1) AS has_previous FROM pages p),
chains AS (
  SELECT session, min(page) AS first_page, max(page) AS last_page, count(*) AS n_pages, count(DISTINCT page) AS n_distinct,
         CAST(sum(n) AS BIGINT) AS n_rows, max(n) AS largest_page,
         bool_or(page > 1 AND NOT has_previous) AS unnamed, bool_or(n <> {s.STANDIN_PAGE_SIZE} AND has_next) AS after_short,
         bool_or(n = {s.STANDIN_PAGE_SIZE} AND NOT has_next) AS open_end
  FROM linked GROUP BY session)
SELECT '{LINE_REPORT}' AS report, session, first_page, last_page, n_pages, n_distinct, n_rows, largest_page,
       largest_page > {s.STANDIN_PAGE_SIZE} AS oversize,
       CASE WHEN first_page > 1 THEN 'missing_start' WHEN n_pages > n_distinct THEN 'duplicate'
            WHEN unnamed OR after_short THEN 'broken' WHEN open_end THEN 'truncated' ELSE 'complete' END AS status
FROM chains"""


@register("page_chain_audit", AUDIT_SQL)
def page_chain_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land pages cut by columns of lineitem as JSON and audit every session."""
    pages = s.line_pages(spark, sf_dir, LINE_REPORT)
    path = scratch_path(spark, "line-pages")
    pages.write.option("compression", LANDED).json(path)
    landed = pg.read_pages(spark, path, pages.schema["resultSet"].dataType.elementType)
    return pg.audit_chains(pg.page_counts(landed), s.STANDIN_PAGE_SIZE)


EXPENSE_FILE_COLUMNS = ["Expense Code", "Expense Type", "Expense Name"]


def _expense_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expense-code file content: some types are NA words, empty or blank."""
    size = F.col("p_size")
    part = s.table(spark, sf_dir, "part")
    code = F.when((size == 1) & (F.col("p_type") == "ECONOMY"), F.lit(None)).otherwise(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string"), F.lit("\t")))
    etype = (F.when(size == 2, "NA").when(size == 3, "None").when(size == 4, "null").when(size == 5, "")
             .when(size == 6, "  ").otherwise(F.col("p_type")))
    return part.select(code.alias("Expense Code"), etype.alias("Expense Type"), F.col("p_name").alias("Expense Name"))


EXPENSE_FILE_SQL = """expense_file AS (
  SELECT CASE WHEN p_size = 1 AND p_type = 'ECONOMY' THEN NULL ELSE 'P' || CAST(p_partkey AS VARCHAR) || chr(9) END AS "Expense Code",
         CASE WHEN p_size IN (2, 3, 4, 5) THEN NULL WHEN p_size = 6 THEN '  ' ELSE p_type END AS "Expense Type",
         p_name AS "Expense Name"
  FROM part)"""


def _scan_expense_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "expense_codes_csv")
    lk.write_lookup_csv(_expense_file_rows(spark, sf_dir), path)
    return lk.read_lookup_csv(spark, path, EXPENSE_FILE_COLUMNS)


@register("lookup_csv_scan", o.with_(EXPENSE_FILE_SQL) + "SELECT * FROM expense_file")
def lookup_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan_expense_file(spark, sf_dir)


@register("lookup_publish", o.with_(EXPENSE_FILE_SQL) + f"""
SELECT DISTINCT trim("Expense Code", {o.WS}) AS "Expense Code", trim("Expense Type", {o.WS}) AS "Expense Type",
       trim("Expense Name", {o.WS}) AS "Expense Name"
FROM expense_file WHERE "Expense Code" IS NOT NULL""")
def lookup_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    published = lk.publish_lookup(_scan_expense_file(spark, sf_dir), "Expense Code")
    path = scratch_path(spark, "expense_codes_parquet")
    published.write.parquet(path)
    return spark.read.parquet(path)


@register("rolling_window", o.with_(o.LINES) + f"""
SELECT * FROM lines WHERE "Line Date" >= TIMESTAMP '{WINDOW_END}' - INTERVAL 84 DAY AND "Line Date" < TIMESTAMP '{WINDOW_END}'""")
def rolling_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return win.rolling_window(s.line_items(spark, sf_dir), "Line Date", WINDOW_END)


@register("fixed_start_window", o.with_(o.INVOICES) + f"""
SELECT * FROM invoices WHERE "Invoice Date" >= TIMESTAMP '{FIXED_START}' AND "Invoice Date" < TIMESTAMP '{WINDOW_END}'""")
def fixed_start_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return win.fixed_start_window(s.invoices(spark, sf_dir), "Invoice Date", FIXED_START, WINDOW_END)


@register("iso_millis", f"""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS ts_iso,
       strftime(ts - INTERVAL 84 DAY, '%Y-%m-%dT%H:%M:%S.%gZ') AS window_start_iso FROM events""")
def iso_millis_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = s.table(spark, sf_dir, "events")
    return ev.select("event_id", iso_millis("ts").alias("ts_iso"),
                     iso_millis(F.col("ts") - F.expr("INTERVAL 12 WEEKS")).alias("window_start_iso"))


@register("report_load", REPORT_LINE_SQL.replace(
    'SELECT m1."Line ID"', "SELECT 'Reporting API - test report' AS report, 'USD' AS currency, 'FLATTENED' AS report_layout, m1.\"Line ID\""))
def report_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line-item report end to end: pages landed as JSON, look-ups landed
    as CSV (size-checked before broadcast), chain audit, cleaning, upsert."""
    from ledgerlake.operators.report_load import load_lookups, load_report

    root = scratch_path(spark, "report_load")
    pages = _line_pages(spark, sf_dir)
    record_schema = pages.schema["resultSet"].dataType.elementType
    pages.write.option("compression", LANDED).partitionBy("report").json(f"{root}/pages")
    lk.write_lookup_csv(s.role_groups(spark), f"{root}/role_groups")
    lk.write_lookup_csv(s.expense_codes(spark, sf_dir), f"{root}/expense_codes")
    lookups = load_lookups(spark, f"{root}/role_groups", f"{root}/expense_codes",
                           ["Expense Code", "Expense Type", "Expense Name"])
    load_report(spark, LINE_REPORT, f"{root}/pages", record_schema, lookups, f"{root}/table", ("pages", 0))
    from ledgerlake.sinks.versioned_dir import ReportTable

    return ReportTable(spark, f"{root}/table", ["Line ID"]).read()
