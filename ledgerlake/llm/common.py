"""Helpers that several corpus operators share."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of the files, not a
    re-run of what made them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only: ``lower`` where all is ASCII (fast), else a translation."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def row_hash(df: DataFrame) -> Column:
    """Hash of all columns (maps cannot be hashed and are left out)."""
    return F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind])


def replace_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drops columns that an operator is about to add (its own names win)."""
    return df.drop(*[c for c in df.columns if c in names])


def shielded(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with other names for columns that start with ``_``, like the operators' own; and the way back."""
    other = {c: f"input {c}" for c in docs.columns if c.startswith("_")}
    return docs.withColumnsRenamed(other), {v: k for k, v in other.items()}


def share(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcasts ``value`` by value (its class included); the result gives it in a task, unpickled once."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    loaded: list[Any] = []

    def get() -> Any:
        if not loaded:
            loaded.append(pickle.loads(sent.value))
        return loaded[0]
    return get


#: Rows of keys and places that a broadcast may hold (about 50 bytes each).
BROADCAST_ROWS = 500_000


def small(staged: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``staged`` (a written table of narrow rows), marked for broadcast if its count allows; else joined by shuffle."""
    return F.broadcast(staged) if staged.count() <= rows else staged
