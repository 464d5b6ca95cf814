"""Queries: cleaning steps, look-up joins and the report registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.nulls import drop_null_key, fill_default
from ledgerlake.functions.text import strip_ws
from ledgerlake.operators.clean import Lookups
from ledgerlake.operators.joins import merge, one_null_row
from ledgerlake.operators.registry import clean_report
from ledgerlake.plans import oracle_sql as o
from ledgerlake.plans import standins as s
from ledgerlake.plans.catalog import register
from ledgerlake.schemas import ROLE_DEFAULT


def lookups(spark: SparkSession, sf_dir: str) -> Lookups:
    # Role groups are a fixed handful of reference rows: a proven bound, so
    # broadcast. Expense codes grow with the part table: no hint, AQE decides
    # from the measured size at run time.
    return Lookups(s.role_groups(spark), s.expense_codes(spark, sf_dir), role_groups_bounded=True)


@register("fill_default_role", o.with_(o.LINES) + """
SELECT "Line ID", coalesce("Role", 'Not Specified') AS "Role" FROM lines""")
def fill_default_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_default(s.line_items(spark, sf_dir), "Role", ROLE_DEFAULT).select("Line ID", "Role")


@register("strip_key", o.with_(o.LINES, o.EXPENSE_CODES) + f"""
SELECT 'line' AS side, trim("Expense Code", {o.WS}) AS "Expense Code" FROM lines
UNION ALL
SELECT 'lookup' AS side, trim("Expense Code", {o.WS}) AS "Expense Code" FROM expense_codes""")
def strip_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = s.line_items(spark, sf_dir).select(F.lit("line").alias("side"), strip_ws("Expense Code").alias("Expense Code"))
    codes = s.expense_codes(spark, sf_dir).select(F.lit("lookup").alias("side"), strip_ws("Expense Code").alias("Expense Code"))
    return lines.unionByName(codes)


@register("drop_null_key", o.with_(o.LINES) + """
SELECT * FROM lines WHERE "Expense Code" IS NOT NULL""")
def drop_null_key_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_null_key(s.line_items(spark, sf_dir), "Expense Code")


@register("role_lookup", o.with_(o.LINES, o.ROLE_GROUPS) + """
, filled AS (SELECT * REPLACE (coalesce("Role", 'Not Specified') AS "Role") FROM lines)
SELECT f."Line ID", f."Invoice ID", coalesce(f."Role", g."Role") AS "Role", f."Expense Code", f."Line Date",
       f."Quantity", f."Amount", g."Group"
FROM filled f FULL JOIN role_groups g ON f."Role" IS NOT DISTINCT FROM g."Role"
WHERE f."Line ID" IS NOT NULL""")
def role_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lk = lookups(spark, sf_dir)
    li = fill_default(drop_null_key(s.line_items(spark, sf_dir), "Line ID"), "Role", ROLE_DEFAULT)
    return merge(li, lk.role_groups.select("Role", "Group"), ["Role"], "left", bounded=True)


@register("expense_lookup_nullsafe", o.with_(o.LINES, o.EXPENSE_CODES) + f"""
, l AS (SELECT * REPLACE (trim("Expense Code", {o.WS}) AS "Expense Code") FROM lines),
  {o.ONE_NULL_CODE.format(ws=o.WS)}
SELECT l."Line ID", l."Invoice ID", l."Role", coalesce(l."Expense Code", e."Expense Code") AS "Expense Code",
       l."Line Date", l."Quantity", l."Amount", e."Expense Type", e."Expense Name"
FROM l FULL JOIN e ON l."Expense Code" IS NOT DISTINCT FROM e."Expense Code"
WHERE l."Line ID" IS NOT NULL""")
def expense_lookup_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = drop_null_key(s.line_items(spark, sf_dir), "Line ID").withColumn("Expense Code", strip_ws("Expense Code"))
    codes = one_null_row(s.expense_codes(spark, sf_dir).withColumn("Expense Code", strip_ws("Expense Code")), "Expense Code")
    return merge(li, codes, ["Expense Code"], "left")


@register("full_outer_lookup", o.with_(o.LINES, o.ROLE_GROUPS) + """
, filled AS (SELECT * REPLACE (coalesce("Role", 'Not Specified') AS "Role") FROM lines)
SELECT f."Line ID", f."Invoice ID", coalesce(f."Role", g."Role") AS "Role", f."Expense Code", f."Line Date",
       f."Quantity", f."Amount", g."Group"
FROM filled f FULL JOIN role_groups g ON f."Role" IS NOT DISTINCT FROM g."Role" """)
def full_outer_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lk = lookups(spark, sf_dir)
    li = fill_default(s.line_items(spark, sf_dir), "Role", ROLE_DEFAULT)
    return merge(li, lk.role_groups.select("Role", "Group"), ["Role"], "full", bounded=True)


@register("join_name_clash", o.with_(o.LINES, o.INVOICES) + """
SELECT l."Line ID", l."Invoice ID", l."Role", l."Expense Code", l."Line Date", l."Quantity",
       l."Amount" AS "Amount_x", i."Gross Total" AS "Amount_y", i."Invoice Status"
FROM lines l LEFT JOIN invoices i ON l."Invoice ID" IS NOT DISTINCT FROM i."Invoice ID" """)
def join_name_clash(spark: SparkSession, sf_dir: str) -> DataFrame:
    inv = s.invoices(spark, sf_dir).select("Invoice ID", F.col("Gross Total").alias("Amount"), "Invoice Status")
    return merge(s.line_items(spark, sf_dir), inv, ["Invoice ID"], "left")


@register("report_matter", o.with_(o.MATTERS) + "SELECT * FROM matters")
def report_matter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_report("Reporting API - matter report", s.matters(spark, sf_dir), lookups(spark, sf_dir))


@register("report_invoice", o.with_(o.INVOICES) + "SELECT * FROM invoices")
def report_invoice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_report("Reporting API - Invoice Level", s.invoices(spark, sf_dir), lookups(spark, sf_dir))


REPORT_LINE_SQL = o.with_(o.LINES, o.ROLE_GROUPS, o.EXPENSE_CODES) + f"""
, filled AS (SELECT * REPLACE (coalesce("Role", 'Not Specified') AS "Role") FROM lines),
  m1 AS (
    SELECT f."Line ID", f."Invoice ID", coalesce(f."Role", g."Role") AS "Role", trim(f."Expense Code", {o.WS}) AS "Expense Code",
           f."Line Date", f."Quantity", f."Amount", g."Group"
    FROM filled f FULL JOIN role_groups g ON f."Role" IS NOT DISTINCT FROM g."Role"),
  {o.ONE_NULL_CODE.format(ws=o.WS)}
SELECT m1."Line ID", m1."Invoice ID", m1."Role", coalesce(m1."Expense Code", e."Expense Code") AS "Expense Code",
       m1."Line Date", m1."Quantity", m1."Amount", m1."Group", e."Expense Type", e."Expense Name"
FROM m1 FULL JOIN e ON m1."Expense Code" IS NOT DISTINCT FROM e."Expense Code"
WHERE m1."Line ID" IS NOT NULL"""


@register("report_line", REPORT_LINE_SQL)
def report_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_report("Reporting API - test report", s.line_items(spark, sf_dir), lookups(spark, sf_dir))


@register("report_timekeeper", o.with_(o.TIMEKEEPERS, o.ROLE_GROUPS) + """
SELECT t."Timekeeper", t."Customer MatterID", coalesce(t."Role", g."Role") AS "Role", t."Rate", t."Timekeeper ID", g."Group"
FROM timekeepers t FULL JOIN role_groups g ON t."Role" IS NOT DISTINCT FROM g."Role"
WHERE t."Timekeeper" IS NOT NULL""")
def report_timekeeper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_report("Timekeeper Report - full data pull down", s.timekeepers(spark, sf_dir), lookups(spark, sf_dir))
