"""Mixing sources to target weights by the cube method.

Every source has a target number of words. A source's rate (target by size) is
a number of whole copies plus a fraction; the fraction is the inclusion
probability of each of its documents. The cube method moves these
probabilities through the null space of the balancing constraints (document
count and words) until nearly all are 0 or 1.

The flight runs on blocks of a source in parallel; each block leaves at most
two undecided documents, and these meet in fewer blocks in the next round. The
last round, one block a source, holds a few documents back and ends with the
landing on these and the undecided.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ledgerlake.llm.common import replace_columns, shielded, stage

#: Undecided documents that one task takes at a time.
BLOCK = 4096
#: Documents of a source that are left for the landing, which tries all 2 ** (HELD + 2) outcomes.
HELD = 12
EPS = 1e-9
UNIT = ["source", "doc_id", "size", "h"]


@F.pandas_udf(LongType())
def count_words(texts: pd.Series) -> pd.Series:
    """Words between ASCII white space (space, \\t to \\r); null: 0."""
    return pd.Series([0 if t is None else len(t.encode("utf-8", "surrogatepass").split()) for t in texts], dtype="int64")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Target words of each source from (source, source_size).

    Sources in code point order (null last) take the weights in turn. No
    target passes ``cap`` times its source; the excess goes to the others by
    weight, again and again. That ends at min(cap * size, level * weight): a
    source is capped if the level needed to fill it is affordable when all
    sources that fill earlier are full.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy("fill", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy()
    w = F.get(F.lit([float(x) for x in weights]), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))))
    capped = F.col("so_far") + F.col("fill") * (F.col("all_w") - F.col("w_so_far")) <= F.col("budget")
    return (sizes.withColumn("w", w)
            .withColumns({"top": cap * F.col("source_size"), "budget": share * F.sum("source_size").over(every), "all_w": F.sum("w").over(every)})
            .withColumn("fill", F.col("top") / F.col("w"))
            .withColumns({"so_far": F.sum("top").over(by_fill), "w_so_far": F.sum("w").over(by_fill)})
            .withColumn("capped", capped)
            .withColumns({"full": F.sum(F.when(F.col("capped"), F.col("top")).otherwise(0.0)).over(every),
                          "open_w": F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("w"))).over(every)})
            .select("source", "source_size", F.when(F.col("capped"), F.col("top")).otherwise(
                F.least(F.col("top"), F.try_divide(F.col("budget") - F.col("full"), F.col("open_w")) * F.col("w"))).alias("target")))


def flight(size: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Moves ``p`` along null vectors of (1, size) until at most two stay inside (0, 1)."""
    p, todo, coins = p.copy(), list(np.flatnonzero((p > EPS) & (p < 1 - EPS))[::-1]), iter(())
    live: list[int] = []
    while True:
        while len(live) < 3 and todo:
            live.append(todo.pop())
        s = [float(size[i]) for i in live]
        if len(live) == 3 and not s[0] == s[1] == s[2]:
            step = (s[1] - s[2], s[2] - s[0], s[0] - s[1])
        elif len(live) >= 2 and s[0] == s[1]:
            step = (1.0, -1.0, 0.0)[:len(live)]
        else:
            return p
        up = down = np.inf
        for i, v in zip(live, step):
            if v:
                room = ((1 - p[i]) / v, p[i] / v) if v > 0 else (-p[i] / v, -(1 - p[i]) / v)
                up, down = min(up, room[0]), min(down, room[1])
        coin = next(coins, None)
        if coin is None:
            coins = iter(rng.random(1024))
            coin = next(coins)
        by = up if coin * (up + down) < down else -down
        for i, v in zip(live, step):
            x = p[i] + by * v
            p[i] = 0.0 if x < EPS else 1.0 if x > 1 - EPS else x
        live = [i for i in live if 0 < p[i] < 1]


def land(size: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Decides what is left (``HELD`` + 2 at most): the 0/1 outcome nearest in words, then in documents.

    All outcomes are compared; a document of difference weighs a tenth of the
    mean size. Equal outcomes: the first in binary order.
    """
    left = np.flatnonzero((p > 0) & (p < 1))
    if not len(left):
        return p
    bits = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    off = bits - p[left]
    cost = np.abs(off @ size[left]) + 0.1 * max(1.0, float(size.mean())) * np.abs(off.sum(axis=1))
    p = p.copy()
    p[left] = bits[int(np.argmin(cost))]
    return p


def _block(landing: bool, turn: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["words", "doc_id", "h"], ascending=[False, True, True], kind="stable")
        name = b"\0" if key[0] is None else str(key[0]).encode()
        rng = np.random.default_rng([zlib.crc32(name), int(key[1]), turn])
        size, p = rows["words"].to_numpy("float64"), rows["p"].to_numpy("float64")
        if landing:  # a few documents of all sizes wait for the landing, whose sums then come out fine
            held = np.unique(np.linspace(0, len(p) - 1, HELD).astype(int))
            fly = np.setdiff1d(np.arange(len(p)), held)
            p = p.copy()
            p[fly] = flight(size[fly], p[fly], rng)
            p = land(size, p)
        else:
            p = flight(size, p, rng)
        rows["p"] = p
        return rows.drop(columns="block")
    return run


def plan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
         weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, block: int = BLOCK) -> DataFrame:
    """Copies to take of every unit: source, doc_id, size, h, n, source_size, target, copies.

    A unit is a document, or rows equal in id, source and text (n of them),
    which get the same copies. A null text has size 0, a null source is a
    source of its own, null ids are units told apart by their texts. A source
    of size 0 has target 0. An empty table gives no units.
    """
    rows = docs.select(F.col(source).alias("source"), F.col(doc_id).alias("doc_id"), count_words(F.col(text)).alias("size"), F.xxhash64(text).alias("h"))
    units = stage(rows.groupBy(*UNIT).agg(F.count("*").alias("n")), "mix-units")
    goal = targets(units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, cap)
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    u, g = units.alias("u"), goal.alias("g")
    units = (u.join(g, F.col("u.source").eqNullSafe(F.col("g.source")))
             .select("u.*", "source_size", "target", F.floor(rate + EPS).alias("base"), F.greatest(rate - F.floor(rate + EPS), F.lit(0.0)).alias("p"),
                     (F.col("size") * F.col("n")).alias("words")))
    open_ = (F.col("p") > EPS) & (F.col("p") < 1 - EPS)
    now = stage(units, "mix-probabilities")
    done, turn = [now.where(~open_)], 0
    schema = now.schema
    while True:
        now = now.where(open_)
        counts = now.groupBy("source").agg(F.count("*").alias("left"))
        most = counts.agg(F.max("left")).first()[0]
        if most is None:
            break
        c = counts.select(F.col("source").alias("_s"), F.ceil(F.col("left") / block).alias("blocks"))
        spread = F.pmod(F.xxhash64("doc_id", "h", F.lit(turn)), F.col("blocks")).alias("block")
        dealt = now.join(c, F.col("source").eqNullSafe(F.col("_s"))).select(*schema.names, spread)
        flown = stage(dealt.groupBy("source", "block").applyInPandas(_block(most <= block, turn), schema), f"mix-flight{turn}")
        if most <= block:
            done.append(flown)
            break
        done.append(flown.where(~open_))
        now, turn = flown, turn + 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select(*UNIT, "n", "source_size", "target", (F.col("base") + F.round("p")).cast("int").alias("copies"))


def mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mixed table: each row of ``docs`` as often as its unit has copies, columns unchanged."""
    docs, back = shielded(docs)
    key = {"_source": F.col(source), "_id": F.col(doc_id), "_h": F.xxhash64(text)}
    p = plan(docs, doc_id=doc_id, text=text, source=source, **options)
    keyed = replace_columns(docs, list(key)).withColumns(key)
    kept = (p.where("copies > 0").select("source", "doc_id", "h", "copies")
            .withColumnsRenamed({"source": "__s", "doc_id": "__d", "h": "__h", "copies": "__copies"}))
    joined = keyed.join(kept, F.col("_id").eqNullSafe(F.col("__d")) & (F.col("_h") == F.col("__h")) & F.col("_source").eqNullSafe(F.col("__s")))
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*[F.col(f"`{c}`") for c in docs.columns]).withColumnsRenamed(back)
