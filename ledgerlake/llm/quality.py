"""Quality: histogram gradient-boosted trees over document statistics, flattened into arrays.

Each text becomes some thirty numbers: character classes, word and line
shapes, repetition, function words. Spark's boosted trees learn from them on a
bounded sample of labelled rows; they bin every feature and choose splits from
histograms of the bins. The fitted trees are then flattened into five arrays,
and every document is scored in Arrow batches by numpy, which walks all trees
for all rows of a batch at once, without a shuffle.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ledgerlake.llm.common import replace_columns, share, shielded, stage

# Frequent function words of the corpus languages.
FUNCTION_WORDS = {w.encode() for w in (
    "the of and to a in is that it for on with as was by this are from at or an be not which "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an "
    "de la le et les des en un du une que est pour qui dans par pas sur au plus ne se "
    "el que y los del las por con una su para es al lo como más o pero").split()}
LETTERS = frozenset([*range(65, 91), *range(97, 123), *range(128, 256)])
WHITE = b" \t\n\r\x0b\x0c"
#: A text is read in pieces of about so many bytes, so that its words are never all in memory.
PIECE = 1 << 20
RUN = re.compile(rb"([^\sA-Za-z0-9\x80-\xff])\1{1,}")
SENTENCE_END = (b".", b"!", b"?", b":", b'"', b"\xe2\x80\x9d", b"\xe3\x80\x82")
#: Labelled rows that learning uses, about (drawn by a hash of the id).
MAX_ROWS = 20_000
SEED = 42


def class_of(members) -> np.ndarray:
    out = np.zeros(256)
    out[list(members)] = 1
    return out


#: Rows: letters, capitals, digits, white space, punctuation of prose, other marks, control bytes, bytes above ASCII.
CLASSES = np.array([class_of(x) for x in (LETTERS, range(65, 91), range(48, 58), WHITE, b".,;:!?'\"()-", b"#$%&*+/<=>@[\\]^_`{|}~", [b for b in range(32) if b not in WHITE], range(128, 256))])


def pieces(raw: bytes) -> Iterator[bytes]:
    """``raw`` cut after about ``PIECE`` bytes, at the next blank if there is one soon."""
    start = 0
    while start < len(raw):
        end = min(len(raw), start + PIECE)
        blank = raw.find(b" ", end, end + 4096)
        end = end if blank < 0 else blank
        yield raw[start:end]
        start = end


def features(text: str | None) -> list[float]:
    """The numbers of a text; a null or empty one has zeros."""
    raw = b"" if text is None else text.encode("utf-8", "surrogatepass")
    counts = np.zeros(256)
    words, pairs, lengths = Counter(), Counter(), Counter()
    shouted = marked = bare = closed = runs = opening = 0
    packer, packed = zlib.compressobj(1), 0
    for piece in pieces(raw):
        counts += np.bincount(np.frombuffer(piece, "uint8"), minlength=256)
        packed += len(packer.compress(piece))
        found = piece.split()
        low = [w.lower() for w in found]
        words.update(low)
        pairs.update(zip(low, low[1:]))
        lengths.update(map(len, found))
        for w, n in Counter(found).items():
            shouted += n * (len(w) > 1 and w.isupper())
            inner = w.strip(b".,;:!?'\"()-")
            marked += n * (bool(inner) and not inner[-1:].isalnum() and inner[-1] < 128)
            bare += n * (not inner)
            closed += n * w.endswith(SENTENCE_END)
            opening += n * w[:1].isupper()
        runs += sum(1 for _ in RUN.finditer(piece))
    packed += len(packer.flush())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    size, n, m = max(1, len(raw)), max(1, sum(words.values())), max(1, len(lines))
    shape = CLASSES @ counts / size
    spread = np.array([*lengths.values()], float) / n
    at = np.array([*lengths], float)
    mean = float(at @ spread) if len(at) else 0.0
    bytes_seen = counts[counts > 0] / size
    word_share = np.array([*words.values()], float) / n
    p = max(1, sum(pairs.values()))
    return [
        math.log1p(len(raw)), math.log1p(sum(words.values())), math.log1p(len(lines)), *map(float, shape),
        mean, math.sqrt(max(0.0, float((at - mean) ** 2 @ spread))) if len(at) else 0.0, float(max(lengths, default=0)),
        len(words) / n, float(word_share.max(initial=0.0)), float(-(word_share * np.log(word_share)).sum()), 1 - len(pairs) / p if pairs else 0.0, max(pairs.values(), default=0) / p,
        float(-(bytes_seen * np.log(bytes_seen)).sum()), packed / size if raw else 0.0, sum(words[w] for w in FUNCTION_WORDS) / n,
        shouted / n, marked / n, bare / n, closed / n, opening / n, runs / n,
        sum(map(len, lines)) / m, 1 - len(set(lines)) / m if lines else 0.0, sum(x.rstrip().endswith(SENTENCE_END) for x in lines) / m, max(map(len, lines), default=0) / size,
    ]


@dataclass
class Trees:
    """All trees in arrays, node by node; leaves lead to themselves.

    A row goes left from a node if its ``feature`` is at most ``threshold``.
    """

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    weights: np.ndarray
    depth: int

    @staticmethod
    def of(model: GBTClassificationModel) -> Trees:
        """Flattens a fitted model from its description, which lists each tree from the top, left before right."""
        nodes: list[list[float]] = []
        roots, weights, deepest = [], [], 0
        lines = iter(model.toDebugString.splitlines())

        def read(line: str, depth: int) -> int:
            nonlocal deepest
            deepest = max(deepest, depth)
            at = len(nodes)
            nodes.append([0, math.inf, at, at, 0.0])
            if leaf := re.fullmatch(r"\s*Predict: (\S+)", line):
                nodes[at][4] = float(leaf[1])
                return at
            split = re.fullmatch(r"\s*If \(feature (\d+) <= (\S+)\)", line)
            nodes[at][:2] = [int(split[1]), float(split[2])]
            nodes[at][2] = read(next(lines), depth + 1)
            next(lines)  # the matching Else
            nodes[at][3] = read(next(lines), depth + 1)
            return at

        for line in lines:
            if tree := re.fullmatch(r"\s*Tree \d+ \(weight (\S+)\):", line):
                weights.append(float(tree[1]))
                roots.append(read(next(lines), 0))
        f, t, left, right, value = zip(*nodes)
        return Trees(np.array(f, int), np.array(t), np.array(left, int), np.array(right, int), np.array(value), np.array(roots), np.array(weights), deepest)

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Of label 1, for each row of ``x``."""
        row = np.arange(len(x))[:, None]
        at = np.tile(self.roots, (len(x), 1))
        for _ in range(self.depth):
            at = np.where(x[row, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-2 * (self.value[at] @ self.weights)))


@dataclass
class Model:
    """``trees``, or the share of label 1 where the rows had no two kinds."""

    trees: Trees | None
    prior: float

    def score(self, df: DataFrame, text: str = "text", into: str = "score") -> DataFrame:
        if self.trees is None:
            return replace_columns(df, [into]).withColumn(into, F.lit(self.prior))
        shared = share(df.sparkSession, self.trees)  # some thousand numbers

        @F.pandas_udf(DoubleType())
        def score(texts: pd.Series) -> pd.Series:
            return pd.Series(shared().probability(np.array([features(t) for t in texts]))) if len(texts) else pd.Series([], dtype=float)

        return df.withColumn("_score", score(F.col(f"`{text}`"))).select(*[F.col(f"`{c}`") for c in df.columns if c != into], F.col("_score").alias(into))


def held_out(doc_id: str = "doc_id"):
    """Rows that learning never sees: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, max_rows: int) -> DataFrame:
    """(text, y): the drawn rows outside the held-out third, each text once; of contradicting labels most count, of a tie 1."""
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(doc_id)).select(doc_id, F.col(label).cast("int").alias("_y"))
    ids = known.select(doc_id).distinct()
    n = ids.count()
    part = F.pmod(F.xxhash64(F.col(doc_id), F.lit(SEED)), F.lit(1 << 30)) < int(min(1.0, max_rows / max(n, 1)) * (1 << 30))
    drawn = known.where(part).groupBy(doc_id).agg(F.avg("_y").alias("_y"))
    rows = docs.select(F.col(doc_id), F.coalesce(F.col(text), F.lit("")).alias("text")).join(drawn, doc_id)
    # By a digest first, so that a text that many rows share is sent once by each task.
    return rows.groupBy(F.xxhash64("text").alias("key")).agg(F.first("text").alias("text"), (F.avg("_y") >= 0.5).cast("double").alias("y")).select("text", "y")


def train(docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id", label: str = "quality", max_rows: int = MAX_ROWS,
          trees: int = 24, depth: int = 4, bins: int = 64) -> Model:
    """Learns from at most about ``max_rows`` labelled rows. Null ids and labels teach nothing.

    Without rows of both labels the model is the share of label 1 (0 without rows).
    """
    @F.pandas_udf(ArrayType(DoubleType()))
    def numbers(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts], dtype=object)

    rows = stage(labelled(docs, labels, text, doc_id, label, max_rows).select(numbers("text").alias("f"), "y"), "quality-features")
    n, good = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    if not n or good in (0, n):
        return Model(None, float(good) / max(1, n))
    # Sorted, so that the same rows learn the same trees however they were dealt out. The sample is bounded.
    table = rows.sort("f", "y").coalesce(4).select(array_to_vector("f").alias("features"), F.col("y").alias("label")).cache()
    model = GBTClassifier(maxIter=trees, maxDepth=depth, maxBins=bins, stepSize=0.2, minInstancesPerNode=2, seed=SEED).fit(table)
    table.unpersist()
    return Model(Trees.of(model), float(good) / n)


def judge(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` with held_out, score and predicted (1 from ``threshold`` on); input columns of these names are replaced.

    Every row is scored over its whole text, repeated rows alike; a null or
    empty text is scored on its numbers like any other, a null id is not held
    out, a score on the threshold counts as 1. Very long texts are read in
    pieces. An empty table gives an empty table.
    """
    model = train(docs, labels, text=text, doc_id=doc_id, **options)
    kept, back = shielded(replace_columns(docs, [c for c in ("held_out", "score", "predicted") if c not in (text, doc_id)]))
    scored = model.score(kept, f"input {text}" if text.startswith("_") else text)
    return scored.withColumnsRenamed(back).withColumns({"held_out": held_out(doc_id), "predicted": (F.col("score") >= threshold).cast("int")})
