"""Report time windows.

The loader asks for the last twelve weeks up to now, and the timekeeper
report from a fixed start. Bounds are arguments (never the wall clock) and
half-open: ``start <= ts < end``. Both are plain comparisons against a
literal, so they are pushed into the parquet scan as row-group filters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.schemas import WINDOW_WEEKS


def _ts(value: str | dt.datetime) -> Column:
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def rolling_window(df: DataFrame, ts: str, end: str | dt.datetime, weeks: int = WINDOW_WEEKS) -> DataFrame:
    """Rows with ``end - weeks <= ts < end``."""
    end_c = _ts(end)
    start_c = end_c - F.expr(f"INTERVAL {int(weeks)} WEEKS")
    return df.filter((F.col(ts) >= start_c) & (F.col(ts) < end_c))


def fixed_start_window(df: DataFrame, ts: str, start: str | dt.datetime, end: str | dt.datetime) -> DataFrame:
    """Rows with ``start <= ts < end`` (full history from a fixed start)."""
    return df.filter((F.col(ts) >= _ts(start)) & (F.col(ts) < _ts(end)))
