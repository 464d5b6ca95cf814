"""Scalar text and time functions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.schemas import NA_STRINGS, WHITESPACE

ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def col_of(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Remove leading and trailing Unicode white space (Python ``str.strip``).

    Plain ``trim`` only removes the blank; a tab or a no-break space stays.
    """
    return F.btrim(col_of(c), F.lit(WHITESPACE))


def na_to_null(c: str | Column) -> Column:
    """Turn the words a pandas CSV reader treats as missing into null.

    A value made only of blanks is kept, as pandas keeps it.
    """
    c = col_of(c)
    return F.when(c.isin(*NA_STRINGS), F.lit(None).cast("string")).otherwise(c)


def iso_millis(c: str | Column) -> Column:
    """ISO-8601 text with milliseconds and a ``Z`` suffix; truncates, never rounds."""
    return F.date_format(col_of(c), ISO_MILLIS)


def byte_length(c: str | Column) -> Column:
    """Length in bytes of the UTF-8 text (warehouse VARCHAR limits are bytes)."""
    return F.octet_length(col_of(c))
