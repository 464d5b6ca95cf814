"""Near-duplicates by SimHash and the generalised pigeonhole principle.

Fingerprints: 64 bits, majority of the hashes of word shingles. Two
fingerprints that differ in at most ``r`` bits, cut into parts with thresholds
t_1..t_m, sum(t_i + 1) = r + 1, agree in some part i up to t_i bits (t_i = -1:
the part is not looked at). So each fingerprint may choose its own thresholds:

1. correlated bits go to the same part (bit correlations over all
   fingerprints), so that the skew gathers there;
2. counts of part values estimate how many candidates a threshold costs;
3. dynamic programming gives each fingerprint its cheapest thresholds;
4. it probes all values within its thresholds; candidates are verified on all
   64 bits.

Buckets beyond ``bucket`` fingerprints are not paired off. Their fingerprints
meet on neighbours instead: two fingerprints differ in at most 2 bits exactly
if some value is within 1 bit of both. At most 65 fingerprints meet on a
value, so this stays linear in any group. (For r other than 2 the values
within r // 2 bits of one and r - r // 2 of the other meet.)
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ledgerlake.llm.common import replace_columns, row_hash, shielded, stage
from ledgerlake.llm.components import components

BITS = 64
SEED = 42
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Rows of hashes whose bits are counted at a time, for very long texts.
CHUNK = 1 << 16
#: Buckets up to this size are paired off; larger ones meet on neighbours.
BUCKET = 64
#: What looking up one value costs, in candidates.
PROBE_COST = 2.0


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of the text as a signed 64-bit number; no words: 0."""
    w = [] if text is None else text.encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split()
    if not w:
        return 0
    n = max(1, len(w) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    grams = zip(*(w[i:] for i in range(shingle))) if len(w) >= shingle else iter([w])
    join = b" ".join
    hashes = np.fromiter((digest(join(g), SEED) for g in grams), "uint64", n)
    ones = np.zeros(BITS, "int64")
    for at in range(0, n, CHUNK):
        part = hashes[at:at + CHUNK]
        ones += np.unpackbits(part.view("uint8").reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype="int64")
    return int(np.packbits(2 * ones > n, bitorder="little").view("int64")[0])


def fingerprints(shingle: int):
    @F.pandas_udf(LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")
    return of


def bits_of(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fps, "int64").view("uint8").reshape(-1, 8), axis=1, bitorder="little")


def part_values(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each fingerprint as one number."""
    out = np.zeros(len(fps), "int64")
    for k, b in enumerate(bits):
        out |= ((fps >> b) & 1) << k
    return out


def correlations(fps: DataFrame) -> np.ndarray:
    """Bit correlations over all fingerprints; each task sends 64 x 64 sums."""
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both, n = np.zeros((BITS + 1, BITS + 1)), 0
        for b in batches:
            x = np.hstack([bits_of(b["fp"].to_numpy()), np.ones((len(b), 1), "uint8")]).astype("float64")
            both += x.T @ x
        yield pd.DataFrame({"at": np.arange(both.size), "n": both.ravel().astype("int64")})

    both = np.zeros((BITS + 1) ** 2)
    for r in fps.mapInPandas(sums, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        both[r["at"]] = r["n"]
    both = both.reshape(BITS + 1, BITS + 1)
    n = max(both[-1, -1], 1.0)
    mean = both[-1, :-1] / n
    cov = both[:-1, :-1] / n - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    return np.abs(cov / np.outer(sd, sd))


def parts_of(corr: np.ndarray, parts: int) -> list[list[int]]:
    """Groups of nearly equal width, each grown from its most correlated pair."""
    left, out = list(range(BITS)), []
    for k in range(parts):
        width = (len(left) + parts - k - 1) // (parts - k)
        group = list(max(combinations(left, 2), key=lambda p: (round(corr[p], 6), -p[0], -p[1]))) if width > 1 else left[:1]
        while len(group) < width:
            group.append(max((b for b in left if b not in group), key=lambda b: (round(float(corr[b, group].mean()), 6), -b)))
        out.append(sorted(group))
        left = [b for b in left if b not in group]
    return out


def halves(part: list[int]) -> list[list[int]]:
    return [part[:len(part) // 2], part[len(part) // 2:]]


def value_counts(fps: DataFrame, parts: list[list[int]]) -> list[list[np.ndarray]]:
    """Counts of the values of each half part: two tables of at most 2 ** 11 numbers a part of 22 bits."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = [[np.zeros(1 << len(h), "int64") for h in halves(p)] for p in parts]
        for b in batches:
            f = b["fp"].to_numpy()
            for i, p in enumerate(parts):
                for j, h in enumerate(halves(p)):
                    sums[i][j] += np.bincount(part_values(f, h), minlength=1 << len(h))
        for i, s in enumerate(sums):
            for j, c in enumerate(s):
                v = np.flatnonzero(c)
                yield pd.DataFrame({"part": i, "half": j, "value": v, "n": c[v]})

    out = [[np.zeros(1 << len(h)) for h in halves(p)] for p in parts]
    for r in fps.mapInPandas(count, "part int, half int, value long, n long").groupBy("part", "half", "value").agg(F.sum("n").alias("n")).collect():
        out[r["part"]][r["half"]][r["value"]] = r["n"]
    return out


def at_distance(counts: np.ndarray, width: int, most: int) -> np.ndarray:
    """[d, value]: how many have a value that differs from ``value`` in exactly d bits."""
    v, out = np.arange(len(counts)), [counts]
    for d in range(1, most + 1):
        out.append(sum((counts[v ^ sum(1 << b for b in flip)] for flip in combinations(range(width), d)), np.zeros(len(counts))))
    return np.stack(out)


def thresholds(fps: np.ndarray, parts: list[list[int]], near: list[list[np.ndarray]], total: float, r: int) -> np.ndarray:
    """[fingerprint, part]: the allocation with the least estimated work, by dynamic programming over parts."""
    spent = np.full((len(fps), r + 2), np.inf)
    spent[:, 0] = 0.0
    choices = []
    for p, (a, b) in zip(parts, near):
        ha, hb = (part_values(fps, h) for h in halves(p))
        cost, probes, seen = [np.zeros(len(fps))], 0, np.zeros(len(fps))
        for t in range(r + 1):
            probes += len(list(combinations(range(len(p)), t)))
            for d in range(t + 1):
                seen = seen + a[d][ha] * b[t - d][hb] / max(total, 1.0)
            cost.append(seen + PROBE_COST * probes)
        table = np.full((len(fps), r + 2, r + 2), np.inf)  # [_, spent after, spent here]
        for after in range(r + 2):
            for here in range(after + 1):
                table[:, after, here] = spent[:, after - here] + cost[here]
        choices.append(table.argmin(axis=2))
        spent = table.min(axis=2)
    out, at, rows = np.zeros((len(fps), len(parts)), "int64"), np.full(len(fps), r + 1), np.arange(len(fps))
    for i in reversed(range(len(parts))):
        here = choices[i][rows, at]
        out[:, i], at = here - 1, at - here
    return out


def index_and_probes(fps: DataFrame, parts: list[list[int]], near: list[list[np.ndarray]], total: float, r: int) -> DataFrame:
    """(part, value, fp, probe): each fingerprint's own part values, and the values that it looks up."""
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            f = batch["fp"].to_numpy()
            t = thresholds(f, parts, near, total, r)
            for i, p in enumerate(parts):
                v = part_values(f, p)
                yield pd.DataFrame({"part": i, "value": v, "fp": f, "probe": False})
                for d in range(r + 1):
                    for flip in combinations(range(len(p)), d):
                        at = t[:, i] >= d
                        if at.any():
                            yield pd.DataFrame({"part": i, "value": v[at] ^ sum(1 << b for b in flip), "fp": f[at], "probe": True})
    return fps.mapInPandas(emit, "part int, value long, fp long, probe boolean")


def meet_on_neighbours(fps: DataFrame, r: int) -> DataFrame:
    """Links (a, b) that connect all fingerprints within r bits of each other, without pairing them.

    Each goes to all values within r // 2 bits (and, for odd r, the near side
    to r // 2 + 1). Those that meet on a value are within r bits.
    """
    if r > 3:
        raise ValueError("neighbours are listed for r up to 3")
    flips = [0, *(1 << b for b in range(BITS))] if r >= 2 else [0]
    far = [x if x < 1 << 63 else x - (1 << 64) for x in flips]
    meet = fps.select("fp", F.explode(F.lit(far)).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"))
    if r % 2:  # the odd bit: one side goes a bit further
        one = [x - (1 << 64) if x >= 1 << 63 else x for x in (0, *(1 << b for b in range(BITS)))]
        wide = meet.select("fp", "value", F.explode(F.lit(one)).alias("flip")).select("fp", F.col("value").bitwiseXOR(F.col("flip")).alias("value"), F.lit(True).alias("wide")).distinct()
        near = meet.select(F.col("fp").alias("b"), "value").distinct()
        return wide.join(near, "value").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()
    groups = meet.groupBy("value").agg(F.collect_list("fp").alias("who")).where("size(who) > 1")
    return groups.select(F.array_min("who").alias("b"), F.explode("who").alias("a")).where("a <> b").select("a", "b").distinct()


def links(fps: DataFrame, r: int = 2, parts: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within ``r`` bits.

    ``fps``: distinct fingerprints (fp). All pairs of small buckets are
    verified; the members of larger ones are linked by ``meet_on_neighbours``.
    """
    total = float(fps.count())
    cut = parts_of(correlations(fps), parts)
    near = [[at_distance(c, len(h), r) for c, h in zip(cs, halves(p))] for cs, p in zip(value_counts(fps, cut), cut)]
    seen = stage(index_and_probes(fps, cut, near, total, r), "simhash-probes")
    size = seen.where("not probe").groupBy("part", "value").agg(F.count("*").alias("n"))
    large = stage(size.where(F.col("n") > bucket).select("part", "value"), "simhash-large")
    small = seen.join(large, ["part", "value"], "left_anti")
    diff = F.bit_count(F.col("p.fp").bitwiseXOR(F.col("x.fp")))
    pairs = (small.where("probe").alias("p").join(small.where("not probe").alias("x"), ["part", "value"])
             .where((F.col("p.fp") != F.col("x.fp")) & (diff <= r)).select(F.col("p.fp").alias("a"), F.col("x.fp").alias("b")))
    crowded = seen.join(large, ["part", "value"], "left_semi").select("fp").distinct()
    return pairs.unionByName(meet_on_neighbours(crowded, r))


def near_duplicates(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", shingle: int = 3, max_bits: int = 2,
                    parts: int = 3, bucket: int = BUCKET) -> DataFrame:
    """One row per document: doc_id, fp (signed), tie (hash of the whole row), root (a fingerprint of the group), component_id.

    component_id: the smallest id that links reach, the document's own
    included. A null text or one without words has fingerprint 0 and is linked
    like any other. Null ids take part (never the smallest); a group of null
    ids only has a null component. Equal texts and repeated rows share a
    fingerprint. An empty table gives no rows.
    """
    keyed = stage(docs.select(F.col(doc_id).alias("doc_id"), fingerprints(shingle)(F.col(text)).alias("fp"), row_hash(docs).alias("tie")), "simhash-docs")
    fps = stage(keyed.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-prints")
    roots = components(links(fps.select("fp"), max_bits, parts, bucket), "simhash-links")
    member = fps.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = member.groupBy("root").agg(F.min("first").alias("component_id"))
    return keyed.join(member.select("fp", "root").join(least, "root").select("fp", "root", "component_id"), "fp")


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id (of equal ids, the smallest row hash)."""
    docs, back = shielded(docs)
    groups = near_duplicates(docs, doc_id=doc_id, **options)
    best = stage(groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root", "component_id")
                 .agg(F.min("tie").alias("tie"), F.count("*").alias("n")), "simhash-kept")
    keyed = replace_columns(docs, ["_tie"]).withColumn("_tie", row_hash(docs))
    b = best.select(F.col("component_id").alias("_c"), F.col("tie").alias("_t"))
    kept = keyed.join(b, F.col(doc_id).eqNullSafe(F.col("_c")) & (F.col("_tie") == F.col("_t")), "left_semi")
    if best.where("n > 1").limit(1).count():  # some ids occur twice: equal rows must not both stay
        kept = kept.dropDuplicates([doc_id, "_tie"])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns]).withColumnsRenamed(back)
