"""URL filter: stated rules first, then logistic regression on hashed character n-grams.

The model learns from a small labelled URL table. The n-grams of host and path
have hashes of their own, and a weight per hash; scoring a URL adds up the
weights of its n-grams, without a shuffle.
"""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import product

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ledgerlake.llm.common import ascii_lower, replace_columns, share, shielded

DIMENSIONS = 1 << 15
SIZES = (3, 4, 5)
MAX_RULES = 1000

# Host words of unwanted and of wanted sites, and the shapes of hosts and paths in which the default training table uses them.
BLOCK_WORDS = ["casino", "poker", "bets", "betting", "slots", "jackpot", "lottery", "pills", "pharma", "viagra", "adult", "porn", "xxx", "sex",
               "escort", "spam", "ads", "adserver", "track", "tracker", "click", "popup", "malware", "warez", "torrent", "crack", "loans", "payday", "replica", "cheap"]
ALLOW_WORDS = ["news", "library", "museum", "garden", "school", "science", "history", "weather", "music", "travel", "recipes", "health", "sports", "forum", "wiki",
               "journal", "research", "university", "books", "city", "river", "mountain", "theatre", "radio", "paper", "letters", "kitchen", "photo", "software",
               "hardware", "docs", "support", "shop", "market", "house", "nature", "animals", "language", "stories", "teachers"]
HOSTS = ["{w}.com", "www.{w}.org", "m.{w}.net", "blog.{w}.de", "{w}-online.fr", "my{w}.info", "{w}24.co.uk", "the-{w}.es", "static.{w}hub.io"]
PATHS = ["", "/", "/index.html", "/en/{n}", "/2024/05/{n}.html", "/{w}/page-{n}", "/item.php", "/a/b/{n}/", "/{w}.pdf"]
#: Rows of a labelled table that may be given.
MAX_LABELLED = 100_000


def labelled_urls() -> list[tuple[str, int]]:
    """The default training table (url, 1 to block): every word in every host shape, the paths in turn."""
    rows = [(w, h, y) for words, y in ((BLOCK_WORDS, 1), (ALLOW_WORDS, 0)) for w, h in product(words, HOSTS)]
    return [("https://" + h.format(w=w) + PATHS[(i + i // len(HOSTS)) % len(PATHS)].format(w=w, n=i), y) for i, (w, h, y) in enumerate(rows)]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    pattern = "://([^/?#]*)([^?#]*)"
    whole = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(whole, pattern, 1)), F.regexp_extract(whole, pattern, 2)


def grams(host: str, path: str) -> dict[int, float]:
    """Hashed n-grams of host and path; counts scaled to length 1."""
    counts: Counter[int] = Counter()
    for kind, s in ((0, f"^{host}$"), (1, f"{path.lower()}$")):
        s = "".join("0" if c.isdigit() else c for c in s)
        raw = s.encode("utf-8", "surrogatepass")
        for n in SIZES:
            counts.update(zlib.crc32(raw[i:i + n], kind) % DIMENSIONS for i in range(len(raw) - n + 1))
    norm = sum(v * v for v in counts.values()) ** 0.5 or 1.0
    return {k: v / norm for k, v in counts.items()}


class Model:
    def __init__(self, weights: np.ndarray, intercept: float) -> None:
        self.weights, self.intercept = weights, intercept

    def score(self, host: str, path: str) -> float:
        x = self.intercept + sum(self.weights[k] * v for k, v in grams(host, path).items())
        return float(1 / (1 + np.exp(-x)))


def train(spark: SparkSession, labelled: DataFrame | list[tuple[str, int]] | None = None) -> Model:
    """Fits the weights on a small labelled table (url, y: 1 to block) of at most ``MAX_LABELLED`` rows.

    Rows with a null label teach nothing. Without rows of both labels every
    url has the share of label 1 for a score (0 without rows).
    """
    @F.pandas_udf(VectorUDT())
    def vector(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        found = [sorted(grams(h, p).items()) for h, p in zip(hosts, paths)]  # sparse vectors, in the columns of their type
        return pd.DataFrame({"type": 0, "size": DIMENSIONS, "indices": [[k for k, _ in x] for x in found], "values": [[v for _, v in x] for x in found]})

    table = labelled if isinstance(labelled, DataFrame) else spark.createDataFrame(labelled_urls() if labelled is None else labelled, "url string, y int")
    n, bad = table.where("y is not null").agg(F.count("*"), F.coalesce(F.sum(F.col("y").cast("int")), F.lit(0))).first()
    if n > MAX_LABELLED:
        raise ValueError(f"more than {MAX_LABELLED} labelled urls")
    if bad in (0, n):
        return Model(np.zeros(DIMENSIONS), np.inf if bad else -np.inf)
    host, path = split_url(F.col("url"))
    rows = table.where("y is not null").select(vector(host, path).alias("features"), F.col("y").cast("double").alias("label"))
    fitted = LogisticRegression(regParam=0.0005, maxIter=100).fit(rows)
    return Model(fitted.coefficients.toArray(), float(fitted.intercept))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null without one.

    ``rules``: (verdict, rule), a rule being a host and the beginning of a
    path. It fits the host and its subdomains. The rules are written into the
    expression, so there may be ``MAX_RULES`` at most.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    rule = verdict = None
    for v, r in sorted(rules, key=lambda x: (-len(x[1]), x[1])):
        at = r.index("/") if "/" in r else len(r)
        name, start = r[:at].translate(str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})), r[at:]
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, r) if rule is None else rule.when(fits, r)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def judge(pages: DataFrame, rules: list[tuple[str, str]], *, url: str = "url", labelled: DataFrame | list[tuple[str, int]] | None = None, threshold: float = 0.5) -> DataFrame:
    """``pages`` with host, path, rule, score and verdict (allow or block: the rule's, else the model's).

    Every row is judged. Null urls and urls without ``://`` have empty host
    and path, fit no rule and are scored as such; repeated urls are judged
    alike; a very long url is one row and is read once. Of rules of equal
    length the first in code-point order wins; a score on the threshold
    blocks. Input columns named like the added ones are replaced. An empty
    table gives no rows. ``labelled``: see ``train``.
    """
    shared = share(pages.sparkSession, train(pages.sparkSession, labelled))  # DIMENSIONS weights

    @F.pandas_udf(DoubleType())
    def score(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        m = shared()
        return pd.Series([m.score(h, p) for h, p in zip(hosts, paths)], dtype="float64")

    pages, back = shielded(pages)
    host, path = split_url(F.col(f"_{url}"))
    named = replace_columns(pages.withColumn(f"_{url}", F.col(url)), ["host", "path", "rule", "score", "verdict"]).withColumns({"host": host, "path": path})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return (named.withColumns({"rule": rule, "score": score("host", "path")})
            .withColumn("verdict", F.coalesce(verdict, F.when(F.col("score") >= threshold, "block").otherwise("allow"))).drop(f"_{url}").withColumnsRenamed(back))
