"""Queries: row ids, change hashes and the versioned invoice fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.hashing import delta_hash, row_id
from ledgerlake.operators import versioning as v
from ledgerlake.plans import oracle_sql as o
from ledgerlake.plans import standins as s
from ledgerlake.plans.catalog import register

SPEC = v.VersionSpec(keys=("Invoice ID",), payload=tuple(o.INVOICE_PAYLOAD), record_type="INVOICE")
RUN_BY = "ledgerlake-load"
STAMP_1 = v.LoadStamp("2000-01-01", RUN_BY, "2000-01-01 06:00:00")
STAMP_2 = v.LoadStamp("2000-02-01", RUN_BY, "2000-02-01 06:00:00")
AS_OF_DAY = "2000-01-15"


def invoice_fact(spark: SparkSession, sf_dir: str, mode: str = "delta") -> DataFrame:
    """The invoice report loaded twice into a versioned table."""
    first, second = s.invoice_loads(spark, sf_dir)
    fact1 = v.initial_load(spark, first, SPEC, STAMP_1)
    return v.versioned_merge(fact1, second, SPEC, STAMP_2, mode)


# ---- oracle text -----------------------------------------------------------

_P = [o.q(c) for c in o.INVOICE_PAYLOAD]
_ID = o.row_id_of("INVOICE", ['"Invoice ID"'])
_H = o.hash_of(_P)


def _cols(alias: str) -> str:
    return ", ".join(o.q(c, alias) for c in o.INVOICE_PAYLOAD)


def _fact_sql(mode: str) -> str:
    """The invoice fact after both loads, as DuckDB SQL: first load = every
    row version 1; second load = current rows joined to the batch (``j``),
    split into kept / closed / reopened rows, plus batch keys never seen."""
    marked = "coalesce(mio_delete_ind = 'Y', false)"
    changed = f"(h IS NOT NULL AND (mio_delta_hash <> h OR {marked}))"
    vanished = f"(h IS NULL AND NOT {marked})" if mode == "full" else "false"
    closing = f"({changed} OR {vanished})"
    payload = ", ".join(_P)
    book = ("mio_delete_ind, mio_current_status, mio_version_number, mio_created_by, mio_create_date_time, "
            "mio_updated_by, mio_update_date_time, mio_source_filename, mio_delta_hash, "
            "mio_version_valid_from, mio_version_valid_to")
    run2 = f"'{RUN_BY}' AS mio_updated_by, TIMESTAMP '2000-02-01 06:00:00' AS mio_update_date_time"
    return o.with_(o.INVOICE_LOADS) + f"""
, v1 AS (
  SELECT {_ID} AS fact_guid, {payload}, CAST(NULL AS VARCHAR) AS mio_delete_ind, true AS mio_current_status,
         1 AS mio_version_number, '{RUN_BY}' AS mio_created_by, TIMESTAMP '2000-01-01 06:00:00' AS mio_create_date_time,
         '{RUN_BY}' AS mio_updated_by, TIMESTAMP '2000-01-01 06:00:00' AS mio_update_date_time,
         CAST(NULL AS VARCHAR) AS mio_source_filename, {_H} AS mio_delta_hash,
         DATE '2000-01-01' AS mio_version_valid_from, CAST(NULL AS DATE) AS mio_version_valid_to
  FROM first_load),
b AS (SELECT *, {_H} AS h, {_ID} AS id FROM second_load),
j AS (SELECT c.*, b.h, b.id, {', '.join(f'{o.q(x, "b")} AS "b_{x}"' for x in o.INVOICE_PAYLOAD)}
      FROM v1 c LEFT JOIN b ON c."Invoice ID" IS NOT DISTINCT FROM b."Invoice ID"),
kept AS (SELECT fact_guid, {payload}, {book} FROM j WHERE NOT {closing}),
closed AS (
  SELECT fact_guid, {payload}, mio_delete_ind, false AS mio_current_status, mio_version_number, mio_created_by,
         mio_create_date_time, {run2}, mio_source_filename, mio_delta_hash, mio_version_valid_from,
         DATE '2000-02-01' AS mio_version_valid_to
  FROM j WHERE {closing}),
reopened AS (
  SELECT fact_guid,
         {', '.join(f'CASE WHEN {changed} THEN "b_{x}" ELSE {o.q(x)} END AS {o.q(x)}' for x in o.INVOICE_PAYLOAD)},
         CASE WHEN {changed} THEN CAST(NULL AS VARCHAR) ELSE 'Y' END AS mio_delete_ind,
         true AS mio_current_status, mio_version_number + 1 AS mio_version_number, mio_created_by, mio_create_date_time,
         {run2}, mio_source_filename, CASE WHEN {changed} THEN h ELSE mio_delta_hash END AS mio_delta_hash,
         DATE '2000-02-01' AS mio_version_valid_from, CAST(NULL AS DATE) AS mio_version_valid_to
  FROM j WHERE {closing}),
fresh AS (
  SELECT id AS fact_guid, {payload}, CAST(NULL AS VARCHAR) AS mio_delete_ind, true AS mio_current_status,
         1 AS mio_version_number, '{RUN_BY}' AS mio_created_by, TIMESTAMP '2000-02-01 06:00:00' AS mio_create_date_time,
         {run2}, CAST(NULL AS VARCHAR) AS mio_source_filename, h AS mio_delta_hash,
         DATE '2000-02-01' AS mio_version_valid_from, CAST(NULL AS DATE) AS mio_version_valid_to
  FROM b WHERE NOT EXISTS (SELECT 1 FROM v1 c WHERE c."Invoice ID" IS NOT DISTINCT FROM b."Invoice ID")),
fact AS (SELECT * FROM kept UNION ALL SELECT * FROM closed UNION ALL SELECT * FROM reopened UNION ALL SELECT * FROM fresh)
"""


FACT_DELTA_SQL = _fact_sql("delta")
FACT_FULL_SQL = _fact_sql("full")


# ---- queries -----------------------------------------------------------------

@register("row_id", o.with_(o.INVOICES) + f"""
SELECT "Invoice ID", {_ID} AS fact_guid, {o.row_id_of('MATTER', ['"Matter Ref"'])} AS fact_matter_guid FROM invoices""")
def row_id_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.invoices(spark, sf_dir).select(
        "Invoice ID", row_id("INVOICE", ["Invoice ID"]).alias("fact_guid"),
        row_id("MATTER", ["Matter Ref"]).alias("fact_matter_guid"),
    )


@register("delta_hash", o.with_(o.INVOICE_LOADS) + f"""
SELECT 'first' AS load, "Invoice ID", {_H} AS mio_delta_hash FROM first_load
UNION ALL SELECT 'second' AS load, "Invoice ID", {_H} AS mio_delta_hash FROM second_load""")
def delta_hash_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = s.invoice_loads(spark, sf_dir)
    h = delta_hash(list(SPEC.payload)).alias("mio_delta_hash")
    return (first.select(F.lit("first").alias("load"), "Invoice ID", h)
            .unionByName(second.select(F.lit("second").alias("load"), "Invoice ID", h)))


@register("classify_changes", o.with_(o.INVOICE_LOADS) + f"""
, c AS (SELECT "Invoice ID" AS k, {_H} AS h FROM first_load),
  b AS (SELECT "Invoice ID" AS k, {_H} AS h FROM second_load)
SELECT coalesce(c.k, b.k) AS "Invoice ID",
       CASE WHEN c.h IS NULL THEN 'new' WHEN b.h IS NULL THEN 'missing'
            WHEN c.h <> b.h THEN 'changed' ELSE 'unchanged' END AS change
FROM c FULL JOIN b ON c.k IS NOT DISTINCT FROM b.k""")
def classify_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = s.invoice_loads(spark, sf_dir)
    fact1 = v.initial_load(spark, first, SPEC, STAMP_1)
    return v.classify_changes(fact1, second, SPEC)


@register("versioned_merge", FACT_DELTA_SQL + "SELECT * FROM fact")
def versioned_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invoice_fact(spark, sf_dir, "delta")


@register("full_refresh_close", FACT_FULL_SQL + "SELECT * FROM fact")
def full_refresh_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invoice_fact(spark, sf_dir, "full")


AS_OF_SQL = FACT_DELTA_SQL + f"""
SELECT * FROM fact WHERE mio_version_valid_from <= DATE '{AS_OF_DAY}'
  AND (mio_version_valid_to IS NULL OR DATE '{AS_OF_DAY}' < mio_version_valid_to)"""


@register("as_of_read", AS_OF_SQL)
def as_of_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.as_of(invoice_fact(spark, sf_dir), AS_OF_DAY)


@register("audit_stamp", FACT_DELTA_SQL + """
SELECT "Invoice ID", mio_version_number, mio_current_status, mio_created_by, mio_create_date_time,
       mio_updated_by, mio_update_date_time FROM fact""")
def audit_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invoice_fact(spark, sf_dir).select(
        "Invoice ID", v.VERSION, v.CURRENT, v.CREATED_BY, v.CREATED_AT, v.UPDATED_BY, v.UPDATED_AT)


@register("current_rows_view", FACT_DELTA_SQL + "SELECT * FROM fact WHERE mio_current_status = true")
def current_rows_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = invoice_fact(spark, sf_dir)
    v.current_rows(fact, SPEC.columns).createOrReplaceTempView("invoice_fact_current")
    return spark.table("invoice_fact_current")


@register("version_chain", """
SELECT *, CAST(row_number() OVER w AS INTEGER) AS version_number, ts AS valid_from,
       lead(ts) OVER w AS valid_to, lead(ts) OVER w IS NULL AS is_current
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def version_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.version_chain(s.table(spark, sf_dir, "events"), ["user_id"], "ts", "event_id")


@register("latest_per_key", """
SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.latest_per_key(s.table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])
