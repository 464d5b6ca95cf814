"""Benchmark decontamination by a broadcast hash set of word windows.

A window is ``window`` consecutive words of a benchmark item (a shorter item
is one window). Windows of the benchmark go to the executors as a hash set;
each document's words are scanned once, and a window found in the set is
verified word by word through the set's equality on whole windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import replace_columns, share, shielded, stage

WINDOW = 13
#: Windows that one broadcast holds at most (about 30 MB); a larger benchmark is scanned for in blocks.
BLOCK_WINDOWS = 250_000
#: Bytes of words: digits, letters (A-Z lower-cased) and all above ASCII; the others part words.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])


def words(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def windows(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Distinct (item, key, n): the windows of every item, words joined by a blank."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = set()
            for item, t in zip(b["item"], b["text"]):
                w = [x.decode("utf-8", "surrogatepass") for x in words(t)]
                n = min(len(w), window)
                out.update((item, " ".join(w[i:i + n]), n) for i in range(len(w) - n + 1 if n else 0))
            yield pd.DataFrame(sorted(out, key=str), columns=["item", "key", "n"])

    rows = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    return rows.mapInPandas(cut, "item string, key string, n int").distinct()


class Index:
    """Hash set of windows over word numbers, one table per window length."""

    def __init__(self, rows: list) -> None:
        self.number: dict[bytes, int] = {}
        self.tables: dict[int, dict[bytes, list[str | None]]] = {}
        for r in rows:
            ids = [self.number.setdefault(w, len(self.number)) for w in r["key"].encode("utf-8", "surrogatepass").split(b" ")]
            self.tables.setdefault(r["n"], {}).setdefault(np.asarray(ids, "int32").tobytes(), []).append(r["item"])

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Word count, merged spans [start, end) of hit words, items found."""
        w = words(text)
        get = self.number.get
        ids = np.fromiter((get(x, -1) for x in w), "int32", len(w))
        known = np.concatenate(([0], np.cumsum(ids >= 0)))
        raw, spans, items = ids.tobytes(), [], set()
        for n, table in self.tables.items():
            for i in np.flatnonzero(known[n:] - known[:-n] == n) if len(w) >= n else ():
                found = table.get(raw[4 * i:4 * (i + n)])
                if found:
                    spans.append((int(i), int(i) + n))
                    items.update(x for x in found if x is not None)
        return len(w), merge(spans), sorted(items)


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scanner(index: Index, spark: SparkSession):
    shared = share(spark, index)

    @F.pandas_udf(FOUND)
    def scan(texts: pd.Series) -> pd.DataFrame:
        index = shared()
        return pd.DataFrame([index.scan(t) for t in texts], columns=["n_words", "spans", "items"])
    return scan


@F.pandas_udf(FOUND["spans"].dataType)
def merged(lists: pd.Series) -> pd.Series:
    return pd.Series([merge([(s["start"], s["end"]) for s in x]) for x in lists])


def find(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text",
         window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Adds ``contamination``: struct of n_words, hit spans (word numbers, end excluded, merged) and items.

    Null texts have no words; items without words have no window; an item
    without an id hits words but is not listed; an empty benchmark hits
    nothing; an input column ``contamination`` is replaced. Equal items are
    found alike. Every item is used: a benchmark beyond one broadcast is
    scanned for in blocks, each of at most ``block_windows`` windows, and
    their findings are merged by text.
    """
    spark = docs.sparkSession
    docs, back = shielded(replace_columns(docs, ["contamination"]))
    w = stage(windows(benchmark, item_id, item_text, window), "bench-windows")
    blocks = max(1, -(-w.count() // block_windows))
    parts = (Index(w.where(F.pmod(F.xxhash64("item", "key"), F.lit(blocks)) == b).collect()) for b in range(blocks))
    if blocks == 1:
        return docs.withColumn("contamination", _scanner(next(parts), spark)(F.col(text))).withColumnsRenamed(back)
    key: Column = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    hits = None
    for p in parts:
        found = docs.select(key.alias("_key"), _scanner(p, spark)(F.col(text)).alias("f")).where("size(f.spans) > 0").dropDuplicates(["_key"])
        found = stage(found, "bench-hits")
        hits = found if hits is None else hits.unionByName(found)
    hits = (hits.groupBy("_key").agg(F.flatten(F.collect_list("f.spans")).alias("_s"),  # one list a block
                                     F.array_sort(F.array_distinct(F.flatten(F.collect_list("f.items")))).alias("_i"))
            .withColumn("_s", merged("_s")))
    bare = _scanner(Index([]), spark)(F.col(text))
    joined = docs.withColumns({"_key": key, "_n": bare["n_words"]}).join(hits, "_key", "left")
    none = F.array().cast(FOUND["spans"].dataType)
    return joined.withColumn("contamination", F.struct(F.col("_n").alias("n_words"), F.coalesce("_s", none).alias("spans"),
                                                       F.coalesce("_i", F.array().cast("array<string>")).alias("items"))).drop("_key", "_n", "_s", "_i").withColumnsRenamed(back)


def n_hit(c: str = "contamination") -> Column:
    return F.aggregate(F.col(c)["spans"], F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def is_contaminated(c: str = "contamination", times: int = 20) -> Column:
    """Hit words are at least one of ``times`` words."""
    return (n_hit(c) > 0) & (times * n_hit(c) >= F.col(c)["n_words"])


def drop_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated ones; columns unchanged."""
    return find(docs, benchmark, **options).where(~is_contaminated()).drop("contamination")


@F.pandas_udf(T.StringType())
def cut_spans(texts: pd.Series, spans: pd.Series) -> pd.Series:
    """The texts without the words of the spans (and what stands between them)."""
    out = []
    for t, cuts in zip(texts, spans):
        if t is None or len(cuts) == 0:
            out.append(t)
            continue
        raw = t.encode("utf-8", "surrogatepass")
        flags = np.frombuffer(raw.translate(WORD_BYTES), "uint8") != 32
        edge = np.diff(np.concatenate(([0], flags.astype("int8"), [0])))
        first, last, kept, at = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), [], 0
        for s in cuts:
            kept.append(raw[at:first[s["start"]]])
            at = last[s["end"] - 1]
        out.append(b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass"))
    return pd.Series(out)


def drop_spans(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """``docs`` with the hit words cut out of their texts; other columns unchanged."""
    return (find(docs, benchmark, text=text, **options)
            .withColumn(text, cut_spans(F.col(text), F.col("contamination.spans"))).drop("contamination"))
