"""Row ids and change hashes.

Each field is written as ``<length>:<text>``, null as ``~``, fields joined by
``|``. The length prefix keeps fields from running together and the null
marker cannot occur as an encoded value, so different rows give different
texts. Only strings, integers, decimals, dates, timestamps and booleans are
hashed; their text form is the same in every SQL engine we check against.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions.text import col_of

NULL_MARK = "~"
FIELD_SEP = "|"


def ident(name: str) -> str:
    """SQL identifier for a column name (blanks and back-ticks allowed)."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _encoded_parts(names: Sequence[str]) -> list[str]:
    parts = []
    for n in names:
        t = f"CAST({ident(n)} AS STRING)"
        parts.append(f"coalesce(concat(CAST(length({t}) AS STRING), ':', {t}), '{NULL_MARK}')")
    return parts


def encode_sql(names: Sequence[str]) -> str:
    """SQL text of :func:`encode_fields` over named columns (one parse on the
    JVM instead of one Python call per expression node)."""
    return f"concat_ws('{FIELD_SEP}', " + ", ".join(_encoded_parts(names)) + ")"


def delta_hash_sql(names: Sequence[str]) -> str:
    return f"sha2({encode_sql(names)}, 256)"


def row_id_sql(record_type: str, keys: Sequence[str]) -> str:
    present = " AND ".join(f"{ident(k)} IS NOT NULL" for k in keys)
    tag = sql_text(f"{len(record_type)}:{record_type}")
    fields = ", ".join([tag] + _encoded_parts(keys))
    return f"CASE WHEN {present} THEN sha2(concat_ws('{FIELD_SEP}', {fields}), 256) END"


def encode_field(c: str | Column) -> Column:
    text = col_of(c).cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit(NULL_MARK))


def encode_fields(columns: Sequence[str | Column]) -> Column:
    return F.concat_ws(FIELD_SEP, *[encode_field(c) for c in columns])


def delta_hash(columns: Sequence[str | Column]) -> Column:
    """SHA-256 (64 hex characters) over the encoded payload columns."""
    if all(isinstance(c, str) for c in columns):
        return F.expr(delta_hash_sql(columns))
    return F.sha2(encode_fields(columns), 256)


def row_id(record_type: str, key_columns: Sequence[str | Column]) -> Column:
    """Stable id of a business row: hash of the record type and its key.

    A key with a null part gives a null id (no parent to point to).
    """
    if all(isinstance(c, str) for c in key_columns):
        return F.expr(row_id_sql(record_type, key_columns))
    present = F.lit(True)
    for c in key_columns:
        present = present & col_of(c).isNotNull()
    return F.when(present, F.sha2(encode_fields([F.lit(record_type), *key_columns]), 256))
