"""One report load, start to end: landed pages -> audit -> rows -> cleaning
-> upsert into the report table (the main program of the source system)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.clean import Lookups
from ledgerlake.operators.registry import clean_report, report
from ledgerlake.schemas import DEFAULT_CURRENCY, ROLE_GROUPS_SCHEMA
from ledgerlake.session import scratch_path
from ledgerlake.sinks.versioned_dir import ReportTable
from ledgerlake.sources import lookups as lk
from ledgerlake.sources import pages as pg


class IncompletePages(RuntimeError):
    """A page chain is truncated or broken: the report would be partial."""


def load_lookups(spark: SparkSession, role_groups_path: str, expense_codes_path: str,
                 expense_columns: list[str]) -> Lookups:
    """Read both look-up files. Spark broadcasts a side whose measured size
    is under its own limit; file sizes say little about that."""
    roles = lk.read_lookup_csv(spark, role_groups_path, ROLE_GROUPS_SCHEMA.names, keep=["Role", "Group"])
    codes = lk.read_lookup_csv(spark, expense_codes_path, expense_columns)
    return Lookups(roles, codes)


def check_chains(pages: DataFrame) -> DataFrame:
    """Audit the page chains of every session; raise when one is incomplete.
    All bad chains are written to a table, whose path the error names."""
    audit = pg.audit_chains(pg.page_counts(pages))
    bad = audit.filter(F.col("status") != "complete")
    count = bad.count()
    if count:
        path = scratch_path(pages.sparkSession, "page-audit")
        bad.write.parquet(path)
        raise IncompletePages(f"incomplete page chains: {count}, listed in {path}")
    return audit


def load_report(spark: SparkSession, name: str, pages_path: str, record_schema: T.StructType,
                lookups: Lookups, table_root: str, batch_id: tuple[str, int] | None = None,
                currency: str = DEFAULT_CURRENCY, partition_expr: str | None = None) -> int | None:
    """Load the landed pages of report ``name`` into its table; returns the
    committed table version (None when ``batch_id`` was already loaded).

    The audit reads the page frames only (parsing skips the records' fields),
    so nothing is kept between the two reads of the files.
    """
    r = report(name)
    check_chains(pg.read_pages(spark, pages_path, record_schema))
    cleaned = clean_report(name, pg.page_rows(pg.read_pages(spark, pages_path, record_schema), currency), lookups)
    return ReportTable(spark, table_root, r.keys, partition_expr).upsert(cleaned, batch_id=batch_id)
