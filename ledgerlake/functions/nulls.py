"""Null tests and defaults."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.text import col_of


def fill_default(df: DataFrame, column: str, value) -> DataFrame:
    """Replace nulls (not empty strings) of ``column`` by ``value``."""
    return df.withColumn(column, F.coalesce(col_of(column), F.lit(value)))


def not_null(columns: Iterable[str]) -> Column:
    cond = F.lit(True)
    for c in columns:
        cond = cond & col_of(c).isNotNull()
    return cond


def drop_null_key(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows whose key columns are all present (pandas ``dropna(subset=...)``)."""
    return df.filter(not_null(columns))
