"""Embedding whitening: leading eigenvectors of the covariance by spectrum slicing.

Vectors are put on a grid of whole numbers, so that counts, sums and products
are exact and do not depend on the order in which tasks finish. Spark makes
the list of distinct vectors, adds up sums and centred products by partition,
and whitens every row; the driver holds one matrix of dimension x dimension.

There, the number of negative pivots of an LDL' factorisation of V - sI says
how many eigenvalues lie below s. Splitting by these counts isolates each
leading eigenvalue, Rayleigh quotient iteration converges to it, and two more
counts beside the result certify its number.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import replace_columns, share, shielded, stage

SCALE = 64
OFFSET = 1_000_000
#: Grid values end here on both sides (larger entries count as this).
LARGEST = 1 << 62
#: Components carry at least this share of the trace; those below are noise of the arithmetic.
LEAST_SHARE = 1e-13
EPS = float(np.finfo("float64").eps)
PART = 60  # bits of the lower part of a long sum


# Spectrum slicing (on the driver: one matrix).

def count_below(v: np.ndarray, s: float) -> int:
    """Eigenvalues of symmetric ``v`` below ``s``: negative pivots of LDL' with full (Bunch-Parlett) pivoting."""
    a = v - s * np.eye(len(v))
    limit = (1 + 17 ** 0.5) / 8
    negative = 0
    while len(a):
        diagonal = np.abs(np.diagonal(a))
        p = int(diagonal.argmax())
        off = np.abs(a)
        np.fill_diagonal(off, 0.0)
        q, r = divmod(int(off.argmax()), len(a))
        if diagonal[p] == 0 and off[q, r] == 0:
            break  # all that is left is zero: these eigenvalues equal s
        if diagonal[p] >= limit * off[q, r]:
            negative += bool(a[p, p] < 0)
            keep = np.arange(len(a)) != p
            column = a[keep, p]
            a = a[np.ix_(keep, keep)] - np.outer(column, column / a[p, p])
        else:  # a 2 x 2 pivot of this kind has one negative eigenvalue
            negative += 1
            keep = np.ones(len(a), bool)
            keep[[q, r]] = False
            block, columns = a[np.ix_([q, r], [q, r])], a[np.ix_(keep, [q, r])]
            a = a[np.ix_(keep, keep)] - columns @ np.linalg.solve(block, columns.T)
        a = (a + a.T) / 2
    return negative


def isolate(v: np.ndarray, k: int, tiny: float) -> list[tuple[float, float, int, int]]:
    """Intervals (a, b, first, count), from the top, that hold the ``k`` leading eigenvalues.

    Each holds one eigenvalue, or is no wider than ``tiny``. ``first``: number
    of its largest eigenvalue, from 1.
    """
    d = len(v)
    radius = np.abs(v).sum(axis=1) - np.abs(np.diagonal(v))
    low, high = float((np.diagonal(v) - radius).min()) - tiny, float((np.diagonal(v) + radius).max()) + tiny
    found, open_ = [], [(low, high, 0, d)]
    while open_:
        a, b, below_a, below_b = open_.pop()
        if below_a == below_b or d - below_b >= k:  # none inside, or all beyond the k leading ones
            continue
        if below_b - below_a == 1 or b - a <= tiny:
            found.append((a, b, d - below_b + 1, below_b - below_a))
            continue
        mid = (a + b) / 2
        below = count_below(v, mid)
        open_ += [(a, mid, below_a, below), (mid, b, below, below_b)]
    return sorted(found, key=lambda x: x[2])


def solve(v: np.ndarray, s: float, x: np.ndarray, tiny: float) -> np.ndarray:
    """The direction of (v - sI)^-1 x; ``s`` moves off an exact eigenvalue."""
    for shift in (s, s + tiny / 8, s - tiny / 8):
        with contextlib.suppress(np.linalg.LinAlgError), np.errstate(all="ignore"):
            y = np.linalg.solve(v - shift * np.eye(len(v)), x)
            size = np.linalg.norm(y / np.abs(y).max()) * np.abs(y).max()
            if np.isfinite(size) and size > 0:
                return y / size
    raise ArithmeticError("the shifted matrix cannot be solved")


def without(x: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for b in basis:
            x = x - (b @ x) * b
    return x / np.linalg.norm(x)


def rayleigh(v: np.ndarray, a: float, b: float, start: np.ndarray, tiny: float) -> tuple[float, np.ndarray] | None:
    """The eigenvalue between ``a`` and ``b`` and its vector; None if the iteration leaves the interval."""
    s = (a + b) / 2
    x = solve(v, s, solve(v, s, start, tiny), tiny)
    best: tuple[float, float, np.ndarray] | None = None
    for _ in range(12):
        e = float(x @ v @ x)
        rest = float(np.linalg.norm(v @ x - e * x))
        if not a <= e <= b:
            return None
        if best is not None and rest >= best[0]:
            break  # as close as the arithmetic allows
        best = (rest, e, x)
        x = solve(v, e, x, tiny)
    return best[1], best[2]


def certified(v: np.ndarray, number: int, e: float, tiny: float) -> bool:
    """Counts beside ``e`` say that the eigenvalue of this number, from the top, is there."""
    return count_below(v, e - tiny) <= len(v) - number < count_below(v, e + tiny)


def leading(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of symmetric ``v``, falling, and unit eigenvectors as columns.

    Equal eigenvalues (to the last bits) get any orthonormal basis of their space.
    """
    d = len(v)
    scale = float(np.abs(v).max(initial=0.0))
    if not d or not k or not scale:
        return np.zeros(0), np.zeros((d, 0))
    v = v / scale
    tiny = 4 * EPS * d * max(1.0, float(np.linalg.norm(v)))
    random = np.random.default_rng(0)
    values, vectors = [], []
    for a, b, first, count in isolate(v, k, tiny):
        for i in range(min(count, k - first + 1)):
            number, pair = first + i, None
            while count == 1 and b - a > tiny and pair is None:
                pair = rayleigh(v, a, b, random.standard_normal(d), tiny)
                if pair is None or not certified(v, number, pair[0], tiny):  # the quotient went to a neighbour: halve the interval and start again
                    mid, pair = (a + b) / 2, None
                    a, b = (mid, b) if d - count_below(v, mid) >= number else (a, mid)
            if pair is None:  # equal eigenvalues: inverse iteration beside the vectors found
                x = without(random.standard_normal(d), vectors)
                for _ in range(4):
                    x = without(solve(v, (a + b) / 2, x, tiny), vectors)
                pair = float(x @ v @ x), x
                if not certified(v, number, pair[0], 2 * tiny):
                    raise ArithmeticError(f"eigenvalue {number} is not certified by the inertia counts")
            e, x = pair
            values.append(e)
            vectors.append(without(x, vectors) if i or values[:-1] and values[-2] - e <= 1e6 * tiny else x)
    return np.array(values) * scale, np.array(vectors).T


# Exact sums (in tasks).

def exact_sum(y: np.ndarray) -> np.ndarray:
    """Column sums of whole numbers, as Python integers."""
    top = int(np.abs(y).max(initial=0))
    return (y if top * len(y) < LARGEST else y.astype(object)).sum(axis=0).astype(object)


def exact_products(y: np.ndarray) -> np.ndarray:
    """y'y of whole numbers, as Python integers: in floating point by blocks whose sums stay below 2**53."""
    top = max(1, int(np.abs(y).max(initial=0)))
    block = (1 << 53) // (top * top)
    if not block:
        y = y.astype(object)
        return y.T @ y
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for i in range(0, len(y), block):
        part = y[i:i + block].astype("float64")
        total += np.rint(part.T @ part).astype("int64").astype(object)
    return total


def matrix(column, d: int) -> np.ndarray:
    """Arrow column of lists of ``d`` whole numbers as a matrix."""
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), "int64").reshape(-1, d)


def add_up(fit: DataFrame, d: int, of: Callable[[np.ndarray], np.ndarray]) -> list[int]:
    """Sums over the fit list of what ``of`` adds up for a batch; a partition sends its totals only."""
    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(matrix(batch.column(0), d)).reshape(-1)
                total = part if total is None else total + part
        if total is not None:
            parts = [(int(x) >> PART, int(x) & ((1 << PART) - 1)) for x in total]
            kind = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([str(h) for h, _ in parts]).cast(kind), pa.array([str(x) for _, x in parts]).cast(kind)],
                                             names=["i", "high", "low"])

    # Sums of decimals stay exact; the result has as many rows as ``of`` gives numbers.
    rows = fit.mapInArrow(totals, "i int, high decimal(38,0), low decimal(38,0)").groupBy("i").agg(
        F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    return [(int(r["high"]) << PART) + int(r["low"]) for r in sorted(rows, key=lambda r: r["i"])]


@dataclass
class Whitening:
    """``values`` (eigenvalues, falling), ``vectors`` (columns) and what else rows need."""

    n: int
    d: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    def __post_init__(self) -> None:
        self.middle = np.array([round(Fraction(s, self.n)) for s in self.sums], "int64") if self.n else np.zeros(0, "int64")
        self.rest = [s - self.n * int(m) for s, m in zip(self.sums, self.middle)]
        self.offset = np.array([float(Fraction(r, self.n)) for r in self.rest]) if self.n else np.zeros(0)
        self.axes = self.vectors / np.sqrt(self.values)

    def whiten(self, y: np.ndarray) -> np.ndarray:
        return ((y - self.middle) - self.offset) @ self.axes

    def deviation(self, y: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n*y - sum)**2, exact; None where it does not fit in a long."""
        u = y - self.middle
        top = int(np.abs(u).max(initial=0)) + 1
        widest = max((abs(r) for r in self.rest), default=0) + 1
        if max(top, widest) * top * self.d >= LARGEST:
            u = u.astype(object)
        r = np.array(self.rest, u.dtype)
        constant = sum(x * x for x in self.rest)
        found = [self.n * self.n * int(a) - 2 * self.n * int(b) + constant for a, b in zip((u * u).sum(axis=1), u @ r)]
        return [x if x < 1 << 63 else None for x in found]


def cells(vector: Column) -> Column:
    """floor(64 * c) of each entry, as long, held within +-2**62."""
    bound = F.lit(float(LARGEST))
    return F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, bound), -bound)).cast("long"))


def usable(vector: Column) -> Column:
    """Not null, and every entry a finite number."""
    inf = F.lit(float("inf"))
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < inf)), F.lit(False))


def fit(df: DataFrame, vector: str = "embedding", components: int = 16) -> Whitening | None:
    """The whitening of the distinct grid vectors of ``df``; None without any usable vector.

    Vectors must have one length: that of most rows counts (of ties the
    greater), others are left out.
    """
    rows = df.where(usable(F.col(vector))).select(cells(F.col(vector)).alias("y"))
    length = rows.groupBy(F.size("y").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if length is None or not length["d"]:
        return None
    d = length["d"]
    distinct = stage(rows.where(F.size("y") == d).distinct(), "whitening-fit")
    counted = add_up(distinct, d, lambda y: np.append(exact_sum(y), len(y)).astype(object))
    sums, n = counted[:-1], counted[-1]
    base = Whitening(n, d, sums, np.zeros(0), np.zeros((d, 0)), 0.0)
    products = np.array(add_up(distinct, d, lambda y, middle=base.middle: exact_products(centred(y, middle))), object).reshape(d, d)
    # The sums are of deviations from the rounded mean; what is left of the mean goes off here, exactly, before rounding.
    v = np.array([[float(Fraction(n * int(products[i, j]) - base.rest[i] * base.rest[j], n * n)) for j in range(d)] for i in range(d)])
    trace = float(np.trace(v))
    values, vectors = leading(v, min(components, d))
    good = values > LEAST_SHARE * trace
    model = Whitening(n, d, sums, values[good], vectors[:, good], trace)
    return measured(model, distinct)


def centred(y: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """y - middle; as Python integers where a difference may leave 64 bits."""
    return y - middle if int(np.abs(y).max(initial=0)) < LARGEST // 2 else y.astype(object) - middle.astype(object)


def measured(model: Whitening, distinct: DataFrame) -> Whitening:
    """Adds identity_error: the covariance of the whitened fit list against the identity, by a pass over it."""
    k = len(model.values)
    if not k:
        return model
    shared = share(distinct.sparkSession, model)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, total = shared(), np.zeros((k + 1, k))
        for batch in batches:
            w = m.whiten(matrix(batch.column(0), m.d))
            total += np.vstack([w.T @ w, w.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.reshape(-1))], names=["i", "x"])

    found = distinct.mapInArrow(totals, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
    total = np.array([r["x"] for r in sorted(found, key=lambda r: r["i"])]).reshape(k + 1, k) / model.n
    model.identity_error = float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())
    return model


def whiten(df: DataFrame, vector: str = "embedding", components: int = 16) -> DataFrame:
    """``df``'s rows of usable vectors, one row for each component: input columns, then component, n, deviation,
    whitened, explained, identity_error (input columns of these names are replaced).

    Left out: null vectors, vectors with null, NaN or infinite entries, and
    vectors of another length than most. Repeated rows and null ids stay, each
    with its own result; equal vectors count once in the fit. Entries beyond
    2**62 / 64 count as that; ``deviation`` is null where it does not fit in a
    long. Components of no variance (constant dimensions, fewer vectors than
    components) are not returned, so one vector alone, or an empty table,
    gives no rows. Vectors may be long; the driver holds one covariance.
    """
    names = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    kept, back = shielded(replace_columns(df, [c for c in names if c != vector]))
    source = f"input {vector}" if vector.startswith("_") else vector
    model = fit(kept, source, components)
    columns = [F.col(f"`{c}`") for c in kept.columns if c not in names]
    kinds = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        nothing = [F.lit(None).cast(kind).alias(c) for c, kind in (x.split(" ") for x in kinds.split(", "))]
        return kept.where(F.lit(False)).select(*columns, *nothing).withColumnsRenamed(back)
    shared = share(df.sparkSession, model)

    @F.pandas_udf("deviation long, whitened array<double>")
    def project(y: pd.Series) -> pd.DataFrame:
        m = shared()
        if not len(y):
            return pd.DataFrame({"deviation": pd.Series([], dtype="Int64"), "whitened": pd.Series([], dtype=object)})
        x = np.stack(y.to_numpy()).astype("int64")
        return pd.DataFrame({"deviation": pd.Series(m.deviation(x), dtype="Int64"), "whitened": list(m.whiten(x))})

    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    rows = kept.where(usable(F.col(source)) & (F.size(source) == model.d)).withColumn("_p", project(cells(F.col(source))))
    out = rows.select(*columns, "_p", F.posexplode("_p.whitened").alias("_i", "whitened"))
    return out.select(*columns, (F.col("_i") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), F.col("_p.deviation").alias("deviation"),
                      "whitened", explained[F.col("_i")].alias("explained"), F.lit(model.identity_error).alias("identity_error")).withColumnsRenamed(back)
