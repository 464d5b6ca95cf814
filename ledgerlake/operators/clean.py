"""Cleaning steps of the four reports.

The source system merges line items with the two look-ups by *full* outer
joins and then drops rows without a ``Line ID`` (timekeepers: without a
``Timekeeper``). Rows of the look-ups that matched nothing carry no line id,
so they always leave again; the net effect is a left join restricted to
rows that have the key. That is how it is written here: the key filter runs
first (and reaches the parquet scan), and the left joins can be broadcast or
skew-split. :func:`ledgerlake.operators.joins.merge` with ``how="full"``
keeps the bare outer join for callers that want it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerlake.functions.nulls import drop_null_key, fill_default
from ledgerlake.functions.text import strip_ws
from ledgerlake.operators.joins import merge, one_null_row
from ledgerlake.schemas import ROLE_DEFAULT


@dataclass(frozen=True)
class Lookups:
    """Look-up frames and whether each has a checked size bound (broadcast)."""

    role_groups: DataFrame
    expense_codes: DataFrame
    role_groups_bounded: bool = False
    expense_codes_bounded: bool = False


def role_group_columns(role_groups: DataFrame) -> DataFrame:
    return role_groups.select("Role", "Group")


def clean_line_items(df: DataFrame, lookups: Lookups) -> DataFrame:
    """Line-item report: default role, role group, stripped expense code. Of
    look-up rows without a code one stands for lines without one (see
    :func:`one_null_row`)."""
    df = drop_null_key(df, "Line ID")
    df = fill_default(df, "Role", ROLE_DEFAULT)
    df = merge(df, role_group_columns(lookups.role_groups), ["Role"], "left",
               bounded=lookups.role_groups_bounded)
    df = df.withColumn("Expense Code", strip_ws("Expense Code"))
    codes = one_null_row(lookups.expense_codes.withColumn("Expense Code", strip_ws("Expense Code")), "Expense Code")
    return merge(df, codes, ["Expense Code"], "left", bounded=lookups.expense_codes_bounded)


def clean_timekeepers(df: DataFrame, lookups: Lookups) -> DataFrame:
    """Timekeeper report: role group (null role meets null role), drop rows
    without a timekeeper."""
    df = drop_null_key(df, "Timekeeper")
    return merge(df, role_group_columns(lookups.role_groups), ["Role"], "left",
                 bounded=lookups.role_groups_bounded)


def pass_through(df: DataFrame, lookups: Lookups | None = None) -> DataFrame:
    """Invoice and matter reports are loaded as delivered."""
    return df
