"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

A lexicon of words and word beginnings is learned from the labelled rows, so
it follows whatever languages the corpus holds; a short list of English
insults and second-person words is fixed. Each text becomes a dozen numbers:
lexicon densities, how often a hit stands near a second-person word, capitals,
punctuation and obfuscation. The trees learn from these.

Learning is on a bounded sample (``max_rows``) of the labelled rows; every
document is scored, over its whole text, without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ledgerlake.llm.common import replace_columns, share, shielded, stage

# Plain insults, and second-person words of the corpus languages.
INSULTS = {"idiot", "moron", "stupid", "dumb", "trash", "scum", "loser", "worthless", "pathetic", "disgusting", "clown", "filth", "vermin", "hate"}
SECOND_PERSON = {"you", "your", "yours", "you're", "u", "ur", "tu", "te", "toi", "vous", "votre", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "usted", "ustedes", "ti", "vosotros"}
LEET = bytes.maketrans(b"013457@$!*", b"oleastasii")

WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
CAPITALS = bytes(range(65, 91))
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
DISGUISED = re.compile(rb"[a-z]+(?:[0-9@$!*#.]+[a-z]+)+")
SHOUTED = re.compile(rb"\b[A-Z]{3,}\b")
STEMS = (4, 5, 6)
NEAR = 5
#: Labelled rows that learning uses at most (drawn by a hash of the id).
MAX_ROWS = 20_000
LEXICON = 400
SEED = 42
FOLDS = 4
MIN_DOCS = 3
MIN_ODDS = 2.0


def words(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def terms(word: bytes) -> list[bytes]:
    """The word and its beginnings; a beginning ends in ``*``."""
    w = word.decode("utf-8", "replace")
    return [word, *(w[:n].encode() + b"*" for n in STEMS if len(w) > n)]


@dataclass
class Features:
    """Numbers of a text. ``weights``: log odds of the lexicon's terms."""

    weights: dict[bytes, float]

    def __post_init__(self) -> None:
        self.insults = {w.encode() for w in INSULTS}
        self.you = {w.encode() for w in SECOND_PERSON}
        self.known: dict[bytes, float] = {}

    def weight(self, word: bytes) -> float:
        x = self.known.get(word)
        if x is None:
            if len(self.known) > 200_000:  # a cache only
                self.known.clear()
            x = self.known[word] = max((self.weights.get(t, 0.0) for t in terms(word)), default=0.0)
        return x

    def best(self, word: bytes) -> bytes:
        return max(terms(word), key=lambda t: (self.weights.get(t, 0.0), t))

    def of(self, text: str | None) -> list[float]:
        raw = b"" if text is None else text.encode("utf-8", "surrogatepass")
        w, size = words(text), max(1, len(raw))
        n = max(1, len(w))
        weight = np.fromiter(map(self.weight, w), "float64", len(w))
        hits = np.flatnonzero(weight)
        often = max(Counter(self.best(w[i]) for i in hits).values(), default=0)
        insults = sum(map(self.insults.__contains__, w))
        near = sum(any(x in self.you for x in w[max(0, i - NEAR):i + NEAR + 1]) for i in hits)
        hidden = [m.translate(LEET, b"#.") for m in DISGUISED.findall(raw.lower())]
        unmasked = sum(1 for x in hidden if x in self.insults or self.weight(x) > 0)
        capitals = len(raw) - len(raw.translate(None, CAPITALS))
        marks = len(raw) - len(raw.translate(None, PUNCTUATION))
        return [
            math.log1p(len(w)), len(hits) / n, math.log1p(len(hits)), float(weight.sum()) / n, math.log1p(float(weight.sum())), float(weight.max(initial=0.0)),
            math.log1p(often), often / n, math.log1p(len({w[i] for i in hits})), insults / n, math.log1p(insults), near / n, near / max(1, len(hits)),
            capitals / size, len(SHOUTED.findall(raw)) / n, marks / size, raw.count(b"!") / n, len(hidden) / n, math.log1p(unmasked),
        ]


def count_terms(rows: DataFrame) -> DataFrame:
    """(term, fold, n1, k1, n2, k2): documents, and toxic ones, that have the term once and twice at least.

    ``rows``: text, y, fold. Every batch is added up before the shuffle.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for fold, part in b.groupby("fold"):
                sums = [Counter() for _ in range(4)]
                for t, y in zip(part["text"], part["y"]):
                    seen = Counter(x for w in words(t) for x in terms(w))
                    twice = [x for x, c in seen.items() if c > 1]
                    sums[0].update(seen.keys())
                    sums[2].update(twice)
                    if y:
                        sums[1].update(seen.keys())
                        sums[3].update(twice)
                yield pd.DataFrame({"term": list(sums[0]), "fold": fold} | {c: [s[x] for x in sums[0]] for c, s in zip(("n1", "k1", "n2", "k2"), sums)})

    return rows.mapInPandas(count, "term binary, fold int, n1 long, k1 long, n2 long, k2 long").groupBy("term", "fold").agg(
        *[F.sum(c).alias(c) for c in ("n1", "k1", "n2", "k2")])


def learn_lexicon(counts: DataFrame, toxic: int, clean: int, without: int | None = None, size: int = LEXICON) -> dict[bytes, float]:
    """Terms that mark toxic documents, by smoothed log odds; those of one fold may be left out.

    Counted both for one and for two occurrences, since a term that clean
    documents have by chance is rarely in them twice. At most ``size`` terms
    reach the driver.
    """
    if without is not None:
        counts = counts.where(F.col("fold") != without)

    def odds(n: str, k: str):
        o = F.log((F.col(k) + 0.5) / (F.lit(toxic) + 1.0)) - F.log((F.col(n) - F.col(k) + 0.5) / (F.lit(clean) + 1.0))
        return F.when(F.col(k) >= MIN_DOCS, o).otherwise(0.0)

    found = (counts.groupBy("term").agg(*[F.sum(c).alias(c) for c in ("n1", "k1", "n2", "k2")]).where(F.col("k1") >= MIN_DOCS)
             .withColumn("odds", F.greatest(odds("n1", "k1"), odds("n2", "k2"))).where(F.col("odds") >= MIN_ODDS)
             .orderBy((F.col("odds") * F.sqrt("k1")).desc(), "term").limit(size).collect())
    return {bytes(r["term"]): r["odds"] for r in found}


@dataclass
class Model:
    features: Features
    trees: GBTClassificationModel | None
    isotonic: IsotonicRegressionModel | None
    prior: float

    def score(self, df: DataFrame, text: str = "text", into: str = "score") -> DataFrame:
        """Adds the calibrated probability; an empty or null text is scored on its features like any other."""
        out, back = shielded(replace_columns(df, [into]))
        if self.trees is None:
            return out.withColumn(into, F.lit(self.prior)).withColumnsRenamed(back)
        shared = share(df.sparkSession, self.features)  # at most LEXICON terms

        @F.pandas_udf(ArrayType(DoubleType()))
        def features(texts: pd.Series) -> pd.Series:
            f = shared()
            return pd.Series([f.of(t) for t in texts])

        names = [F.col(f"`{c}`") for c in out.columns]
        out = self.trees.transform(out.withColumn("_features", array_to_vector(features(F.col(text)))))
        out = out.withColumn("_margin", vector_to_array("_probability")[1])
        if self.isotonic is None:
            return out.withColumn(into, F.col("_margin")).select(*names, into).withColumnsRenamed(back)
        out = self.isotonic.transform(out)
        return (out.withColumn(into, F.least(F.greatest(F.col("_calibrated"), F.lit(0.0)), F.lit(1.0)))
                .select(*names, into).withColumnsRenamed(back))


def held_out(doc_id: str = "doc_id"):
    """Rows that learning never sees: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def labelled_texts(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, max_rows: int) -> DataFrame:
    """(key, text, y): the drawn rows outside the held-out third, each text once, toxic if any label of it says so."""
    known = (labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).groupBy(doc_id).agg(F.max(F.col(label).cast("int")).alias("_y"))
             .where(~held_out(doc_id)))
    n = known.count()
    drawn = known.where(F.pmod(F.xxhash64(F.col(doc_id), F.lit(SEED)), F.lit(1 << 30)) < int(min(1.0, max_rows / max(n, 1)) * (1 << 30)))
    rows = docs.select(F.col(doc_id), F.coalesce(F.col(text), F.lit("")).alias("_text")).join(drawn, doc_id)
    return rows.groupBy(F.xxhash64("_text").alias("key")).agg(F.first("_text").alias("text"), F.max("_y").alias("y"))


def out_of_fold(table: DataFrame, boost: GBTClassifier, each: list[tuple[int, int]]) -> DataFrame:
    """(label, _margin) of every row, from trees that have not seen the row's fold.

    ``each``: toxic and clean rows of every fold. Where the other folds have
    rows of one kind only, the margin is their share of toxic rows.
    """
    parts = []
    for i, (toxic, clean) in enumerate(each):
        if not toxic + clean:
            continue
        k, n = (sum(x[j] for h, x in enumerate(each) if h != i) for j in (0, 1))
        own = table.where(F.col("fold") == i)
        if k and n:
            trees = boost.fit(table.where(F.col("fold") != i))
            parts.append(trees.transform(own).select("label", vector_to_array("_probability")[1].alias("_margin")))
        else:
            parts.append(own.select("label", F.lit(k / max(1, k + n)).alias("_margin")))
    return reduce(DataFrame.unionByName, parts)


def train(docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
          max_rows: int = MAX_ROWS) -> Model:
    """Learns from labelled rows outside the held-out third.

    Repeated labels of an id and labels of equal texts count once (toxic if any
    says so); null ids and null labels teach nothing. Without rows of both
    kinds the model is their share (0 without rows). The calibration learns
    from margins that each row gets by trees of the other folds, however few
    rows there are.
    """
    rows = stage(labelled_texts(docs, labels, text, doc_id, label, max_rows), "toxicity-rows")
    both = rows.agg(F.count("*"), F.sum("y")).first()
    if not both[0] or both[1] in (0, both[0]):
        return Model(Features({}), None, None, float(both[1] or 0) / max(1, both[0]))
    # A lexicon fits its own rows too well, so the trees see each fold through the lexicon of the others.
    rows = rows.withColumn("fold", F.pmod(F.xxhash64("key", F.lit(SEED + 1)), F.lit(FOLDS)).cast("int"))
    counts = stage(count_terms(rows.select("text", "y", "fold")), "toxicity-terms")
    toxic, clean = int(both[1]), int(both[0] - both[1])
    each = [(r["k"], r["n"] - r["k"]) for r in (rows.where(F.col("fold") == i).agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("k")).first() for i in range(FOLDS))]
    f = Features(learn_lexicon(counts, toxic, clean))
    shared = share(docs.sparkSession, [Features(learn_lexicon(counts, toxic - k, clean - c, i)) for i, (k, c) in enumerate(each)])

    @F.pandas_udf(ArrayType(DoubleType()))
    def features(texts: pd.Series, folds: pd.Series) -> pd.Series:
        of = shared()
        return pd.Series([of[i].of(t) for t, i in zip(texts, folds)])

    table = stage(rows.select(features("text", "fold").alias("f"), "y", "fold"), "toxicity-features").select(
        array_to_vector("f").alias("_features"), F.col("y").cast("double").alias("label"), "fold").cache()
    boost = GBTClassifier(featuresCol="_features", labelCol="label", predictionCol="_prediction", maxIter=15, maxDepth=3, stepSize=0.3, seed=SEED)
    boost = boost.setRawPredictionCol("_raw").setProbabilityCol("_probability")
    margin = out_of_fold(table, boost, each)
    isotonic = IsotonicRegression(featuresCol="_margin", labelCol="label", predictionCol="_calibrated").fit(margin)
    trees = boost.fit(table)
    table.unpersist()
    return Model(f, trees, isotonic, float(both[1]) / both[0])


def judge(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` with held_out, score and predicted (1 from ``threshold`` on); input columns of these names are replaced.

    Every row is scored over its whole text, however long, and repeated rows
    alike. A null or empty text is scored on its numbers like any other, a null
    id is not held out, a score on the threshold counts as toxic. An empty
    table gives an empty table.
    """
    m = train(docs, labels, text=text, doc_id=doc_id, **options)
    return (m.score(replace_columns(docs, ["held_out", "score", "predicted"]), text).withColumns(
        {"held_out": held_out(doc_id), "predicted": (F.col("score") >= threshold).cast("int")}))


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows predicted toxic; columns unchanged (of clashing names, the input's values)."""
    hidden = [c for c in ("held_out", "score", "predicted") if c in docs.columns]
    renamed = docs.withColumnsRenamed({c: f"_in_{c}" for c in hidden})
    kept = judge(renamed, labels, **options).where("predicted = 0")
    return kept.drop("held_out", "score", "predicted").withColumnsRenamed({f"_in_{c}": c for c in hidden}).select(*[F.col(f"`{c}`") for c in docs.columns])
