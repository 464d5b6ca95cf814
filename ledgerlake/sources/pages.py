"""Landed report pages.

A report arrives as a chain of pages. Each page is one JSON object::

    {"resultSet": [{...flat record...}, ...],
     "paging": {"sessionId": "...", "identifier": "..."},
     "pagingIdentifier": "...", "report": "...", "page": 1}

``paging.identifier`` names the page that follows; ``pagingIdentifier`` is the
name under which this page was asked for (null: the first one of its session).
The service hands out the next page while a page is full (exactly
``PAGE_SIZE`` rows); a shorter page ends the chain, and an oversize single
page (the full timekeeper dump) is complete on its own.

Instead of walking the chain sequentially over HTTP, the pages are landed as
files and read in parallel splits. Rows come out with ``inline``; the chains
are verified by :func:`audit_chains`.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.schemas import CURRENCIES, DEFAULT_CURRENCY, PAGE_SIZE, REPORT_LAYOUT

PAGING_SCHEMA = T.StructType([
    T.StructField("sessionId", T.StringType()),
    T.StructField("identifier", T.StringType()),
])


def page_schema(record_schema: T.StructType) -> T.StructType:
    """Schema of one landed page whose records have ``record_schema``."""
    return T.StructType([
        T.StructField("resultSet", T.ArrayType(record_schema)),
        T.StructField("paging", PAGING_SCHEMA),
        T.StructField("pagingIdentifier", T.StringType()),
        T.StructField("report", T.StringType()),
        T.StructField("page", T.LongType()),
    ])


def read_pages(spark: SparkSession, path: str, record_schema: T.StructType | None = None,
               multi_line: bool = False) -> DataFrame:
    """Read landed pages, one row per page.

    Give ``record_schema`` in production: inferring a schema scans every file
    once more. ``multi_line`` reads one pretty-printed page per file.
    """
    reader = spark.read.option("multiLine", multi_line).option("mode", "FAILFAST")
    if record_schema is not None:
        reader = reader.schema(page_schema(record_schema))
    return reader.json(path)


def page_rows(pages: DataFrame, currency: str = DEFAULT_CURRENCY, keep: Iterable[str] = ("report",)) -> DataFrame:
    """Flatten pages into report rows and tag them with the request currency.

    ``inline`` runs inside the scan's stage (a Generate node), no shuffle.
    """
    if currency not in CURRENCIES:
        raise ValueError(f"unknown currency {currency!r}; expected one of {CURRENCIES}")
    keep = [c for c in keep if c in pages.columns]
    return (
        pages.select(*keep, F.inline("resultSet"))
        .withColumn("currency", F.lit(currency))
        .withColumn("report_layout", F.lit(REPORT_LAYOUT))
    )


def union_pages(frames: Iterable[DataFrame]) -> DataFrame:
    """Stack page frames by column name; a column missing in a page is null."""
    frames = list(frames)
    if not frames:
        raise ValueError("no pages to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def page_counts(pages: DataFrame) -> DataFrame:
    """One row per landed page: report, session, page, asked, next, n_rows (an empty page counts 0)."""
    return pages.select("report", F.col("paging.sessionId").alias("session"), "page", F.col("pagingIdentifier").alias("asked"),
                        F.col("paging.identifier").alias("next"), F.coalesce(F.size("resultSet"), F.lit(0)).alias("n_rows"))


CHAIN = ("report", "session")
#: Rows that a task of the audit counts by name, so its memory does not grow with the pages.
NAMES_PER_TASK = 500_000


def audit_chains(counts: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Completeness of every page chain: one row per report and session.

    ``counts``: rows of :func:`page_counts`. A page and the page it names meet
    under the name: each page sends two rows, one for the name it was asked by
    and one for the name it gives, which are counted per chain and name and
    then per chain. The first step is spread by name, so a session with most
    of the pages fills no single task, over as many tasks as the pages need
    (they are counted for that); the second adds up before it shuffles.

    status, the first that holds:
      ``missing_start``  no first page
      ``duplicate``      a page landed more than once
      ``broken``         a page that no landed page names, or one after a short page
      ``truncated``      a full page whose next page never landed
      ``complete``       else
    ``oversize``: a page holds more than ``page_size`` rows (it ends its chain).
    """
    full = F.col("n_rows") == page_size
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    asked = F.struct(F.col("asked").alias("name"), one.alias("pages"), none.alias("by_full"), none.alias("by_short"),
                     F.when(full & F.col("next").isNull(), 1).otherwise(0).cast("long").alias("stuck"),
                     F.col("n_rows").cast("long").alias("rows"), F.col("page").cast("long").alias("page"))
    given = F.struct(F.col("next").alias("name"), none.alias("pages"), F.when(full, 1).otherwise(0).cast("long").alias("by_full"),
                     F.when(full, 0).otherwise(1).cast("long").alias("by_short"), none.alias("stuck"),
                     none.alias("rows"), F.lit(None).cast("long").alias("page"))
    sent = counts.select(*CHAIN, F.inline(F.when(F.col("next").isNull(), F.array(asked)).otherwise(F.array(asked, given))))
    spark = counts.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-2 * counts.count() // NAMES_PER_TASK))
    sent = sent.repartition(tasks, *CHAIN, "name")
    names = sent.groupBy(*CHAIN, "name").agg(
        *[F.sum(c).alias(c) for c in ("pages", "by_full", "by_short", "stuck", "rows")],
        F.max("rows").alias("largest"), F.min("page").alias("first_page"), F.max("page").alias("last_page"))

    def some(cond):
        return F.max(F.when(cond, 1).otherwise(0)) == 1

    asked_for = F.col("pages") > 0
    chains = names.groupBy(*CHAIN).agg(
        F.min("first_page").alias("first_page"), F.max("last_page").alias("last_page"), F.sum("pages").alias("n_pages"),
        F.sum(F.when(asked_for, 1).otherwise(0)).alias("n_distinct"), F.sum("rows").alias("n_rows"), F.max("largest").alias("largest_page"),
        some(asked_for & F.col("name").isNull()).alias("__start"),
        some(asked_for & F.col("name").isNotNull() & (F.col("by_full") + F.col("by_short") == 0)).alias("__unnamed"),
        some(asked_for & (F.col("by_short") > 0)).alias("__after_short"),
        some(~asked_for & (F.col("by_full") > 0) | (F.col("stuck") > 0)).alias("__open"))
    status = (F.when(~F.col("__start"), "missing_start").when(F.col("n_pages") > F.col("n_distinct"), "duplicate")
              .when(F.col("__unnamed") | F.col("__after_short"), "broken").when(F.col("__open"), "truncated").otherwise("complete"))
    return chains.select(*CHAIN, "first_page", "last_page", "n_pages", "n_distinct", "n_rows", "largest_page",
                         (F.col("largest_page") > page_size).alias("oversize"), status.alias("status"))
