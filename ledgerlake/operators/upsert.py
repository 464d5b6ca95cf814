"""Key-based replacement of report tables.

The source system deletes every target row whose key is in the batch and
then appends the whole batch. Here the delete is an anti join against the
*distinct* batch keys (a hash aggregate with map-side combine, so a key
repeated a million times costs one shuffled row), matched null-safely: a
null key in the batch removes the null-key rows of the target. The new
table is written as a new version (see :mod:`ledgerlake.sinks.versioned_dir`),
so delete and append switch together.

At scale the batch keys are small next to the target: AQE turns the anti
join into a broadcast hash join at run time when they fit the threshold, so
the target is scanned once and never shuffled; above it, a sort-merge anti
join whose skewed target partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.joins import key_match
from ledgerlake.schemas import is_payload_column


def _q(c: str):
    return F.col(f"`{c}`")


def batch_keys(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    return batch.select(*[_q(k).alias(f"__bk{i}") for i, k in enumerate(keys)]).distinct()


def delete_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key (single or composite) is not in the batch."""
    keys = list(keys)
    bk = batch_keys(batch, keys)
    cond = key_match(target, bk, [(k, f"__bk{i}") for i, k in enumerate(keys)], null_safe=True)
    return target.join(bk, cond, "left_anti")


def align_to(target_schema_df: DataFrame, batch: DataFrame) -> DataFrame:
    """Shape ``batch`` like the target: its column order and types; columns
    the batch lacks are null. A batch column unknown to the target is an
    error, as an insert into the table would be."""
    extra = [c for c in batch.columns if c not in target_schema_df.columns]
    if extra:
        raise ValueError(f"batch columns not in the target table: {extra}")
    return batch.select(*[
        (_q(f.name) if f.name in batch.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target_schema_df.schema.fields
    ])


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Append all batch rows, duplicates included, in the target's shape."""
    return target.unionByName(align_to(target, batch))


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whole-row replacement by key: delete the batch keys, append the batch.

    Every batch row stays, also several rows with one key; an empty batch
    leaves the target as it is.
    """
    return append(delete_by_key(target, batch, keys), batch)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (partial aggregation
    before the shuffle, so a hot key is summed map-side)."""
    return (
        df.groupBy(*[_q(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def payload_columns(df: DataFrame) -> list[str]:
    """Columns that are neither bookkeeping (mio_*) nor ids (*_guid), in order."""
    return [c for c in df.columns if is_payload_column(c)]


def select_payload(df: DataFrame) -> DataFrame:
    return df.select(*[_q(c) for c in payload_columns(df)])


def insert_from_batch(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows (payload columns of the target) whose key the target lacks.
    The target is first cut down to the keys of the batch, so what is
    gathered per key follows the batch, not the target."""
    cols = payload_columns(target)
    bk = batch.select(*[_q(k).alias(f"__bk{i}") for i, k in enumerate(keys)]).distinct()
    met = target.join(bk, key_match(target, bk, [(k, f"__bk{i}") for i, k in enumerate(keys)], null_safe=True), "left_semi")
    tk = met.select(*[_q(k).alias(f"__tk{i}") for i, k in enumerate(keys)]).distinct()
    cond = key_match(batch, tk, [(k, f"__tk{i}") for i, k in enumerate(keys)], null_safe=True)
    return batch.join(tk, cond, "left_anti").select(*[_q(c) for c in cols])


def update_from_batch(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows with every payload column taken from the matching batch
    row ("newly"); rows without a match are unchanged. The batch must have
    one row per key (see :func:`ledgerlake.operators.versioning.latest_per_key`).
    """
    keys = list(keys)
    cols = payload_columns(target)
    newly = batch.select(
        *[_q(k).alias(f"__nk{i}") for i, k in enumerate(keys)],
        F.lit(True).alias("__matched"),
        *[_q(c).alias(f"__new_{c}") for c in cols if c not in keys],
    )
    cond = key_match(target, newly, [(k, f"__nk{i}") for i, k in enumerate(keys)], null_safe=True)
    joined = target.join(newly, cond, "left")
    matched = F.col("__matched").isNotNull()
    return joined.select(*[
        (F.when(matched, F.col(f"`__new_{c}`")).otherwise(_q(c)).alias(c) if c in cols and c not in keys else _q(c))
        for c in target.columns
    ])
