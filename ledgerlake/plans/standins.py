"""Report-shaped frames built from the benchmark tables.

The real inputs are landed report pages; the benchmark ships TPC-H-like
tables instead. These functions give them the shape of the four reports
(column names as delivered by the report service, blanks included) so every
registered query runs on whole tables. Nulls are introduced by rules on
data values, since the tables hold none.

    line-item report   lineitem   key "Line ID"
    invoice report     orders     key "Invoice ID"
    matter report      customer   key "Matter Ref"
    timekeeper report  supplier   key ("Timekeeper", "Customer MatterID")
    expense codes      part       key "Expense Code" (with blanks around it)
    role groups        fixed reference rows, key "Role" (repeated once)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.schemas import ROLE_GROUPS_SCHEMA
from ledgerlake.sources.scan import read_parquet

# Reference rows of the role-group look-up: "R" is listed twice on purpose
# (a repeated look-up key multiplies rows), "Z" matches no line, and one
# row has no role.
ROLE_GROUP_ROWS = [
    ("A", "Associate"),
    ("R", "Reviewer"),
    ("R", "Reviewer (legacy)"),
    ("Not Specified", "Unassigned"),
    ("Z", "Unused"),
    (None, "No role"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def money(c: str) -> Column:
    return F.col(c).cast("decimal(15,2)")


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def line_id() -> Column:
    return F.concat_ws(
        "-", text("l_orderkey"), text("l_linenumber"), text("l_partkey"), text("l_suppkey"),
        text(F.round(F.col("l_extendedprice") * 100).cast("bigint")),
    )


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-item report. Role null for return flag N; expense code padded on
    the left, null for N/O lines of quantity 1."""
    li = table(spark, sf_dir, "lineitem")
    no_code = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O") & (F.col("l_quantity") == 1)
    return li.select(
        line_id().alias("Line ID"),
        text("l_orderkey").alias("Invoice ID"),
        F.when(F.col("l_returnflag") == "N", F.lit(None)).otherwise(F.col("l_returnflag")).alias("Role"),
        F.when(no_code, F.lit(None)).otherwise(F.concat(F.lit(" P"), text("l_partkey"))).alias("Expense Code"),
        F.col("l_shipdate").alias("Line Date"),
        F.col("l_quantity").alias("Quantity"),
        money("l_extendedprice").alias("Amount"),
    )


def expense_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expense-code look-up from part; code padded with a tab on the right,
    null for every part of size 1."""
    p = table(spark, sf_dir, "part")
    no_code = F.col("p_size") == 1
    return p.select(
        F.when(no_code, F.lit(None)).otherwise(F.concat(F.lit("P"), text("p_partkey"), F.lit("\t"))).alias("Expense Code"),
        F.col("p_type").alias("Expense Type"),
        F.col("p_name").alias("Expense Name"),
    )


def role_groups(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ROLE_GROUP_ROWS, ROLE_GROUPS_SCHEMA)


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        text("o_orderkey").alias("Invoice ID"),
        text("o_custkey").alias("Matter Ref"),
        F.col("o_orderdate").alias("Invoice Date"),
        F.col("o_orderstatus").alias("Invoice Status"),
        money("o_totalprice").alias("Gross Total"),
        F.col("o_orderpriority").alias("Priority"),
    )


def matters(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        text("c_custkey").alias("Matter Ref"),
        F.col("c_name").alias("Matter"),
        text("c_nationkey").alias("Country"),
        F.col("c_mktsegment").alias("Department"),
        money("c_acctbal").alias("Budget"),
    )


def timekeepers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timekeeper report: no timekeeper for negative balances, no role below
    1000, role A below 5000, else R."""
    s = table(spark, sf_dir, "supplier")
    bal = F.col("s_acctbal")
    return s.select(
        F.when(bal < 0, F.lit(None)).otherwise(F.col("s_name")).alias("Timekeeper"),
        text("s_nationkey").alias("Customer MatterID"),
        F.when(bal < 1000, F.lit(None)).when(bal < 5000, F.lit("A")).otherwise(F.lit("R")).alias("Role"),
        money("s_acctbal").alias("Rate"),
        text("s_suppkey").alias("Timekeeper ID"),
    )


#: Rows of a full page in :func:`line_pages`; the service's own size would leave every page short.
STANDIN_PAGE_SIZE = 2


def _page_file(pages: DataFrame, report: str) -> DataFrame:
    """Pages as the service sends them: page n names page n + 1, the first was asked for by no name."""
    number = F.col("page").cast("long")
    return pages.select(
        "resultSet", F.struct(F.col("session").alias("sessionId"), (number + 1).cast("string").alias("identifier")).alias("paging"),
        F.when(number > 1, number.cast("string")).alias("pagingIdentifier"), F.lit(report).alias("report"), number.alias("page"))


def line_pages(spark: SparkSession, sf_dir: str, report: str) -> DataFrame:
    """Pages cut by columns of lineitem: session = order, page = line number.
    Line numbers have gaps, often start above 1, and repeat; rows of one
    number but another line status come as a second copy of the page."""
    li = table(spark, sf_dir, "lineitem")
    record = F.struct(line_id().alias("Line ID"), money("l_extendedprice").alias("Amount"))
    pages = li.groupBy(text("l_orderkey").alias("session"), F.col("l_linenumber").alias("page"), "l_linestatus").agg(F.collect_list(record).alias("resultSet"))
    return _page_file(pages, report)


def invoice_pages(lines: DataFrame, report: str) -> DataFrame:
    """Complete chains: the lines of an invoice are the one page of its session."""
    record = F.struct(*[F.col(f"`{c}`") for c in lines.columns])
    return _page_file(lines.groupBy(F.col("Invoice ID").alias("session")).agg(F.collect_list(record).alias("resultSet")).withColumn("page", F.lit(1)), report)


# Two loads of a report, cut by business date: the first load holds
# everything before FIRST_LOAD_END, the second everything from
# SECOND_LOAD_START on. Rows of the overlap year come again: open ones are
# re-sent as fulfilled and low-priority ones lost their priority (changed),
# the rest unchanged. Older keys are absent from the second load; newer ones
# are new.
FIRST_LOAD_END = "2000-01-01 00:00:00"
SECOND_LOAD_START = "1999-01-01 00:00:00"


def _before(c: str, ts: str) -> Column:
    return F.col(c) < F.lit(ts).cast("timestamp_ntz")


def invoice_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    inv = invoices(spark, sf_dir)
    first = inv.filter(_before("Invoice Date", FIRST_LOAD_END))
    overlap = _before("Invoice Date", FIRST_LOAD_END)
    second = inv.filter(~_before("Invoice Date", SECOND_LOAD_START)).select(
        "Invoice ID", "Matter Ref", "Invoice Date",
        F.when(overlap & (F.col("Invoice Status") == "O"), F.lit("F")).otherwise(F.col("Invoice Status")).alias("Invoice Status"),
        "Gross Total",
        F.when(overlap & (F.col("Priority") == "5-LOW"), F.lit(None)).otherwise(F.col("Priority")).alias("Priority"),
    )
    return first, second


def line_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line positions keyed by ("Invoice ID", "Line No"); the pair is not
    unique in the data, and "Line No" is null for quantity 50."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        text("l_orderkey").alias("Invoice ID"),
        F.when(F.col("l_quantity") == 50, F.lit(None)).otherwise(F.col("l_linenumber")).alias("Line No"),
        text("l_partkey").alias("Part"),
        F.col("l_quantity").alias("Quantity"),
        money("l_extendedprice").alias("Amount"),
        F.col("l_linestatus").alias("Line Status"),
        F.col("l_shipdate").alias("Line Date"),
    )


def line_position_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lp = line_positions(spark, sf_dir)
    first = lp.filter(_before("Line Date", FIRST_LOAD_END))
    overlap = _before("Line Date", FIRST_LOAD_END)
    second = lp.filter(~_before("Line Date", SECOND_LOAD_START)).withColumn(
        "Line Status", F.when(overlap & (F.col("Line Status") == "O"), F.lit("F")).otherwise(F.col("Line Status"))
    )
    return first, second


# Fact-named stand-ins: the four sources with warehouse column names.
SOURCE_SYSTEM = "REPORT_API"


def fact_lines(spark: SparkSession, sf_dir: str, quantity: Column | None = None) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    if quantity is None:
        quantity = F.col("l_quantity").cast("decimal(5,2)")
    return li.select(
        line_id().alias("line_id"),
        text("l_orderkey").alias("invoice_id"),
        text("l_suppkey").alias("timekeeper_id"),
        F.col("l_linestatus").alias("line_type"),
        F.col("l_shipdate").alias("line_date"),
        quantity.alias("adjusted_line_quantity"),
        money("l_extendedprice").alias("adjusted_line_amount"),
        F.col("l_returnflag").alias("role"),
        F.concat(F.lit("P"), text("l_partkey")).alias("expense_code"),
    )


def fact_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        text("o_orderkey").alias("invoice_id"),
        text("o_custkey").alias("matter_ref"),
        F.col("o_orderdate").alias("invoice_date"),
        F.col("o_orderstatus").alias("invoice_status"),
        money("o_totalprice").alias("gross_total"),
        F.col("o_orderpriority").alias("invoice_payment_status"),
    )


def fact_matters(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        text("c_custkey").alias("matter_ref"),
        F.col("c_name").alias("matter"),
        text("c_nationkey").alias("country"),
        F.col("c_mktsegment").alias("department"),
        money("c_acctbal").alias("budget_in_customer_currency"),
    )


def fact_timekeepers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        text("s_suppkey").alias("timekeeper_id"),
        F.col("s_name").alias("timekeeper"),
        text("s_nationkey").alias("customer_matter_id"),
    )


def raw_time_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line rows as landed text-ish values: returned lines (flag R) are
    time entries whose quantity arrives in minutes instead of hours, which
    overflows the table's decimal(5,2) from 16.67 hours on."""
    qty = F.when(F.col("l_returnflag") == "R", F.col("l_quantity") * 60).otherwise(F.col("l_quantity"))
    return fact_lines(spark, sf_dir, qty)
