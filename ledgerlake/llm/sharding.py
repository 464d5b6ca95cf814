"""Balanced shards by sampled splitters.

Records are ordered by a key that starts with the hash of their text, so equal
texts are neighbours. A size-weighted sample of keys gives quantile
boundaries; every range gets its exact bytes and rows; ranges that one hot key
overfills are subdivided. Global byte positions (range offset plus running sum
inside the range) then cut the order into shards of near-equal bytes.

The law is ``bytes``. A group of equal texts stays in one shard as long as it
is at most ``group_share`` of a shard; a larger one is cut where balance needs
it, since it could fill several shards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import replace_columns, shielded, stage

KEYS = ["_h", "_k", "_tie", "_size", "_crc"]
OUT = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
SEED = 42
PIECE_BITS = 30


@dataclass(frozen=True)
class Ranges:
    """Boundaries from the sample; ``pieces`` > 1 marks an overfull range."""

    bounds: list[int]
    pieces: list[int]

    @property
    def first(self) -> list[int]:
        out, n = [], 0
        for p in self.pieces:
            out.append(n)
            n += p
        return out


def with_keys(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Adds the sort key, the size (UTF-8 bytes plus 1) and the CRC-32 of the text."""
    t = F.coalesce(F.col(text), F.lit(""))
    rest = [F.col(f"`{c}`") for c, kind in docs.dtypes if c not in (text, doc_id) and not kind.startswith("map")]
    return (replace_columns(docs, KEYS)
            .withColumns({"_h": F.xxhash64(t), "_k": F.xxhash64(F.col(doc_id), F.lit(SEED)),
                          "_tie": F.xxhash64(*rest) if rest else F.lit(0).cast("long"),
                          "_size": F.octet_length(t).cast("long") + 1, "_crc": F.crc32(t)}))


def sample_ranges(keys: DataFrame, total: int, ranges: int, samples: int) -> Ranges:
    """Quantile boundaries of about ``samples`` keys drawn in proportion to size.

    The draw is a hash of the row's key, so a rerun draws the same rows. What
    reaches the driver is bounded by ``samples``: at most as many draws again
    come from rounding, since each row's draws are its share of ``samples``
    rounded up or down.
    """
    share = F.col("_size") * F.lit(samples / max(total, 1))
    coin = F.pmod(F.xxhash64("_k", "_h", "_tie", F.lit(SEED + 1)), F.lit(1 << PIECE_BITS)) / F.lit(float(1 << PIECE_BITS))
    draws = keys.select("_h", (F.floor(share) + (coin < share - F.floor(share)).cast("long")).alias("n")).where("n > 0")
    drawn = sorted((r["_h"], r["n"]) for r in draws.groupBy("_h").agg(F.sum("n").alias("n")).collect())
    quota = max(1.0, sum(n for _, n in drawn) / ranges)
    bounds, pieces, filled = [], [1], 0.0
    for h, n in drawn:
        if n >= 2 * quota:  # one key overfills a range: a range of its own, in pieces
            if not bounds or bounds[-1] != h:
                bounds.append(h)
                pieces.append(1)
            pieces[-1] = int(n / quota) + 1
            bounds.append(h + 1)
            pieces.append(1)
            filled = 0.0
            continue
        if filled + n > quota and (not bounds or bounds[-1] < h):
            bounds.append(h)
            pieces.append(1)
            filled = 0.0
        filled += n
    return Ranges(bounds, pieces)


def _lookup(values: list[int], index: Column) -> Column:
    return F.get(F.lit(values), index.cast("int"))


def with_range(df: DataFrame, r: Ranges) -> DataFrame:
    """Adds the number of the row's range, or piece of an overfull range: binary search in the boundaries."""
    if r.bounds:
        steps = [1 << b for b in reversed(range(len(r.bounds).bit_length()))]
        at = F.aggregate(F.lit(steps), F.lit(0), lambda pos, step: F.when(
            (pos + step <= len(r.bounds)) & (_lookup(r.bounds, pos + step - 1) <= F.col("_h")), pos + step).otherwise(pos))
    else:
        at = F.lit(0)
    whole = F.lit(1 << PIECE_BITS)
    piece = F.floor(F.pmod("_k", whole) * _lookup(r.pieces, F.col("_at")) / whole).cast("int")
    return df.withColumn("_at", at).withColumn("_range", _lookup(r.first, F.col("_at")) + piece).drop("_at")


def with_position(df: DataFrame, offsets: dict[int, tuple[int, int]], total: int, shards: int, group_share: float) -> DataFrame:
    """Shard and global row position, from range offsets and sums inside the range."""
    n = max(offsets, default=0) + 1
    in_range = Window.partitionBy("_range").orderBy("_h", F.pmod("_k", F.lit(1 << PIECE_BITS)), "_k", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    group = Window.partitionBy("_range", "_h")
    limit = int(group_share * total / shards)
    return (df.withColumns({"_end": F.sum("_size").over(in_range) + _lookup([offsets.get(i, (0, 0))[0] for i in range(n)], F.col("_range")),
                            "_row": F.row_number().over(in_range) - 1 + _lookup([offsets.get(i, (0, 0))[1] for i in range(n)], F.col("_range"))})
            .withColumns({"_group": F.sum("_size").over(group), "_start": F.min(F.col("_end") - F.col("_size")).over(group)})
            .withColumn("_twice_mid", F.when(F.col("_group") <= limit, 2 * F.col("_start") + F.col("_group"))
                        .otherwise(2 * F.col("_end") - F.col("_size")))
            .withColumn("shard", F.least(F.expr(f"(_twice_mid * {shards}L) div {2 * max(total, 1)}L"), F.lit(shards - 1)).cast("int"))
            .drop("_end", "_group", "_start", "_twice_mid"))


def shard(docs: DataFrame, *, shards: int = 16, text: str = "text", doc_id: str = "doc_id", ranges_per_shard: int = 64,
          samples_per_range: int = 20, group_share: float = 0.01, keys_only: bool = False) -> DataFrame:
    """Puts every row into one of ``shards`` shards of near-equal bytes.

    Adds size (UTF-8 bytes of the text plus 1), text_crc32, law, shard, slot
    (gapless from 0 in its shard) and grown_shard (null: the law is not by
    key); input columns of these names are replaced, all others kept.
    ``keys_only`` returns the id and the added columns alone, without reading
    the texts a second time.

    Null texts count as empty (size 1, CRC 0); null ids are keys like others;
    repeated rows are neighbours and get slots of their own; an empty table
    gives no rows; a very long text is one row, and shards differ by at most
    about one group of ``group_share`` of a shard or one row.

    Driver: ``shards * ranges_per_shard * samples_per_range`` sampled keys and
    two numbers a range, whatever the input.
    """
    docs, back = shielded(docs)
    ranges = shards * ranges_per_shard
    keys = stage(with_keys(docs, text, doc_id).select(doc_id, *KEYS), "shard-keys")
    total = keys.agg(F.coalesce(F.sum("_size"), F.lit(0))).first()[0]
    r = sample_ranges(keys, total, ranges, ranges * samples_per_range)
    ranged = with_range(keys, r)
    offsets, at_bytes, at_rows = {}, 0, 0
    for x in ranged.groupBy("_range").agg(F.sum("_size").alias("b"), F.count("*").alias("n")).orderBy("_range").collect():
        offsets[x["_range"]] = (at_bytes, at_rows)
        at_bytes, at_rows = at_bytes + x["b"], at_rows + x["n"]
    placed = with_position(ranged, offsets, total, shards, group_share)
    first = dict.fromkeys(range(shards), 0) | {x["shard"]: x["at"] for x in placed.groupBy("shard").agg(F.min("_row").alias("at")).collect()}
    if not keys_only:
        placed = with_position(with_range(with_keys(replace_columns(docs, OUT), text, doc_id), r), offsets, total, shards, group_share)
    return (placed.withColumns({"size": F.col("_size"), "text_crc32": F.col("_crc"), "law": F.lit("bytes"),
                                "slot": (F.col("_row") - _lookup([first[i] for i in range(shards)], F.col("shard"))).cast("long"),
                                "grown_shard": F.lit(None).cast("int")})
            .drop(*KEYS, "_row", "_range").withColumnsRenamed(back))
