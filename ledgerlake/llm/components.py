"""Connected components of a link table, by large-star and small-star rounds.

Each round points every node at the smallest node it knows; the rounds end
when the links no longer change, at one star a component. Rounds are grouping
and joins only, so a node with very many links is split like any skewed key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import stage


def _large(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    rest = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) but the roots themselves.

    Root: the smallest node of the component. Links of a node to itself and
    repeated links change nothing; nulls are not nodes; no links, no rows.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, mark, turn = stage(links, f"{name}-0"), None, 0
    while True:
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(now) == mark or now[0] == 0:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark, turn = tuple(now), turn + 1
        links = stage(_small(_large(links)), f"{name}-{turn}")
