"""Queries: key-based delete, append, upsert, column lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.operators import upsert as u
from ledgerlake.plans import oracle_sql as o
from ledgerlake.plans import standins as s
from ledgerlake.plans.catalog import register

INVOICE_KEY = ["Invoice ID"]
LINE_KEY = ["Invoice ID", "Line No"]

NOT_IN_SECOND = """NOT EXISTS (SELECT 1 FROM second_load b WHERE b."Invoice ID" IS NOT DISTINCT FROM t."Invoice ID")"""
LINES_NOT_IN_SECOND = """NOT EXISTS (SELECT 1 FROM second_lines b WHERE b."Invoice ID" IS NOT DISTINCT FROM t."Invoice ID"
                                           AND b."Line No" IS NOT DISTINCT FROM t."Line No")"""


@register("delete_by_key", o.with_(o.INVOICE_LOADS) + f"SELECT * FROM first_load t WHERE {NOT_IN_SECOND}")
def delete_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = s.invoice_loads(spark, sf_dir)
    return u.delete_by_key(first, second, INVOICE_KEY)


@register("delete_by_composite_key", o.with_(o.LINE_POSITION_LOADS) + f"SELECT * FROM first_lines t WHERE {LINES_NOT_IN_SECOND}")
def delete_by_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = s.line_position_loads(spark, sf_dir)
    return u.delete_by_key(first, second, LINE_KEY)


@register("append_keep_duplicates", o.with_(o.LINE_POSITION_LOADS) + """
SELECT * FROM first_lines UNION ALL SELECT * FROM second_lines""")
def append_keep_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = s.line_position_loads(spark, sf_dir)
    return u.append(first, second)


@register("upsert_by_key", o.with_(o.INVOICE_LOADS) + f"""
SELECT * FROM first_load t WHERE {NOT_IN_SECOND}
UNION ALL SELECT * FROM second_load""")
def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = s.invoice_loads(spark, sf_dir)
    return u.upsert(first, second, INVOICE_KEY)


@register("upsert_by_composite_key", o.with_(o.LINE_POSITION_LOADS) + f"""
SELECT * FROM first_lines t WHERE {LINES_NOT_IN_SECOND}
UNION ALL SELECT * FROM second_lines""")
def upsert_by_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = s.line_position_loads(spark, sf_dir)
    return u.upsert(first, second, LINE_KEY)


@register("duplicate_keys", o.with_(o.LINE_POSITIONS) + """
SELECT "Invoice ID", "Line No", count(*) AS n_rows FROM line_positions GROUP BY "Invoice ID", "Line No" HAVING count(*) > 1""")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return u.duplicate_keys(s.line_positions(spark, sf_dir), LINE_KEY)


@register("insert_from_batch", o.with_(o.INVOICE_LOADS) + """
SELECT b.* FROM second_load b
WHERE NOT EXISTS (SELECT 1 FROM first_load t WHERE t."Invoice ID" IS NOT DISTINCT FROM b."Invoice ID")""")
def insert_from_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = s.invoice_loads(spark, sf_dir)
    return u.insert_from_batch(first, second, INVOICE_KEY)


@register("update_from_batch", o.with_(o.INVOICE_LOADS) + """
SELECT t."Invoice ID",
       CASE WHEN b."Invoice ID" IS NOT NULL THEN b."Matter Ref" ELSE t."Matter Ref" END AS "Matter Ref",
       CASE WHEN b."Invoice ID" IS NOT NULL THEN b."Invoice Date" ELSE t."Invoice Date" END AS "Invoice Date",
       CASE WHEN b."Invoice ID" IS NOT NULL THEN b."Invoice Status" ELSE t."Invoice Status" END AS "Invoice Status",
       CASE WHEN b."Invoice ID" IS NOT NULL THEN b."Gross Total" ELSE t."Gross Total" END AS "Gross Total",
       CASE WHEN b."Invoice ID" IS NOT NULL THEN b."Priority" ELSE t."Priority" END AS "Priority"
FROM first_load t LEFT JOIN second_load b ON t."Invoice ID" IS NOT DISTINCT FROM b."Invoice ID" """)
def update_from_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = s.invoice_loads(spark, sf_dir)
    return u.update_from_batch(first, second, INVOICE_KEY)
