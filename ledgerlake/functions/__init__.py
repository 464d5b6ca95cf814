"""Scalar functions: text cleaning, null handling, hashing."""

from ledgerlake.functions.hashing import delta_hash, encode_fields, row_id
from ledgerlake.functions.nulls import drop_null_key, fill_default, not_null
from ledgerlake.functions.text import byte_length, iso_millis, na_to_null, strip_ws

__all__ = [
    "byte_length", "delta_hash", "drop_null_key", "encode_fields", "fill_default",
    "iso_millis", "na_to_null", "not_null", "row_id", "strip_ws",
]
