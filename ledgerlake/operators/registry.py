"""Report registry: report name -> target table, key and cleaning step."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerlake.operators.clean import Lookups, clean_line_items, clean_timekeepers, pass_through
from ledgerlake.schemas import REPORTS


@dataclass(frozen=True)
class Report:
    name: str
    table: str
    keys: tuple[str, ...]
    clean: Callable[[DataFrame, Lookups], DataFrame]


_CLEANERS = {
    "invoice_level": pass_through,
    "matter_report": pass_through,
    "test_report": clean_line_items,
    "timekeeper_report": clean_timekeepers,
}

REGISTRY = {
    name: Report(name, table, tuple(keys), _CLEANERS[table])
    for name, (table, keys) in REPORTS.items()
}


def report(name: str) -> Report:
    try:
        return REGISTRY[name]
    except KeyError:
        raise ValueError(f"unknown report {name!r}; known reports: {sorted(REGISTRY)}") from None


def clean_report(name: str, df: DataFrame, lookups: Lookups) -> DataFrame:
    """Run the cleaning step registered for report ``name``."""
    r = report(name)
    return df.transform(lambda d: r.clean(d, lookups))
