"""Position of each row within its key, and the following row's values.

``row_number()`` / ``lead()`` over ``Window.partitionBy(key)`` put every row
of a key into one task. One key may hold a third of all rows, or most rows of
a key may share one timestamp, so that task would run alone for most of the
job. Here rows are first dealt by ranges of the whole (key, order) tuple, the
tie-breaker included:

1. ``repartitionByRange`` samples the tuples and picks splitters, for any
   sortable types. The pieces are about equal however skewed the keys are and
   however many rows tie on the first order column. They are written once with
   their number, so a piece is stored data: tasks that are run again after a
   lost executor, and all later steps, see the same pieces.
2. ``row_number`` / ``lead`` over (key, piece): groups are bounded by a piece.
3. Per (key, piece): row count and the first row's values; over a key's pieces
   (at most one row each) the running sum of counts is the offset and the next
   row's first values are what the last row of a piece is followed by.
4. Join back on (key, piece): position = offset + local position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.session import scratch_path

KEY, PIECE = "__key", "__piece"


def _c(x: str | Column) -> Column:
    return F.col(f"`{x}`") if isinstance(x, str) else x


def in_pieces(df: DataFrame, keys: Sequence[str], order: Sequence[str], pieces: int | None = None) -> DataFrame:
    """``df`` written once, with its key as one struct (null-safe) and the number of its range piece."""
    spark = df.sparkSession
    n = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *[_c(x).asc_nulls_first() for x in [*keys, *order]]).withColumn(PIECE, F.spark_partition_id())
    path = scratch_path(spark, "pieces")
    dealt.write.parquet(path)
    return spark.read.schema(dealt.schema).parquet(path).withColumn(KEY, F.struct(*[_c(k) for k in keys]))


def sequence_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    carry: Sequence[str] = (),
    *,
    seq_col: str = "seq",
    next_prefix: str = "next_",
    slices: int | None = None,
) -> DataFrame:
    """Add ``seq_col`` (1-based position among rows of the same key, by
    ``order``) and ``next_<c>`` for each ``c`` in ``carry`` (value on the next
    row of the key, null on the last). ``order`` must make rows of a key
    unique (add a tie-breaker column); ascending, nulls first. ``slices``:
    number of pieces (default: the shuffle partitions)."""
    ordered = [_c(o).asc_nulls_first() for o in order]
    rows = in_pieces(df, keys, order, slices)
    first = F.min_by(F.struct(*[_c(c).alias(c) for c in carry]), F.struct(*[_c(o) for o in order])) if carry else F.lit(None)
    stats = rows.groupBy(KEY, PIECE).agg(F.count(F.lit(1)).alias("__cnt"), first.alias("__first"))
    along = Window.partitionBy(KEY).orderBy(PIECE)
    stats = stats.withColumn("__off", F.coalesce(F.sum("__cnt").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    for c in carry:
        stats = stats.withColumn(f"__snext_{c}", F.lead(F.col("__first")[c]).over(along))

    inside = Window.partitionBy(KEY, PIECE).orderBy(*ordered)
    local = rows.withColumns({"__lseq": F.row_number().over(inside), **{f"__lnext_{c}": F.lead(_c(c)).over(inside) for c in carry}})
    out = local.join(stats.drop("__first"), [KEY, PIECE], "inner")
    last = F.col("__lseq") == F.col("__cnt")
    added = {seq_col: (F.col("__off") + F.col("__lseq")).cast("long")}
    added.update({f"{next_prefix}{c}": F.when(last, F.col(f"__snext_{c}")).otherwise(F.col(f"__lnext_{c}")) for c in carry})
    return out.withColumns(added).select(*[_c(c) for c in df.columns], *added)
