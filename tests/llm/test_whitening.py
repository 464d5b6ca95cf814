"""Whitening against numpy's dense eigensolver on the same grid."""

import math
from fractions import Fraction

import numpy as np
import pytest

from ledgerlake.llm import queries, whitening

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, component string, _p int"


def brute(vectors, k):
    """n, sums, deviation, whitened and explained of grid vectors, from the definition."""
    x = [tuple(math.floor(64 * c) + 1_000_000 for c in v) for v in vectors]
    fit = sorted(set(x))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    c = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums)] for v in fit])
    cov = c.T @ c / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    own = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums)] for v in x])
    return n, [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x], own @ q / np.sqrt(e), e / np.trace(cov)


def check(found, vectors, k):
    n, deviation, whitened, explained = brute(vectors, k)
    got = {}
    for r in found:
        got[(r["vec_id"], r["component"])] = r
    assert len(got) == len(found) == len(vectors) * len(explained)
    w = np.array([[got[(i, c + 1)]["whitened"] for c in range(len(explained))] for i in range(len(vectors))])
    assert np.abs(np.abs(w) - np.abs(whitened)).max() < 1e-6
    signs = np.sign((w * whitened).sum(axis=0))
    assert np.abs(w - signs * whitened).max() < 1e-6  # one sign for all rows
    for i, d in enumerate(deviation):
        assert got[(i, 1)]["deviation"] == d and got[(i, 1)]["n"] == n
    assert np.allclose([got[(0, c + 1)]["explained"] for c in range(len(explained))], explained, rtol=1e-9)
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-8


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = {r["vec_id"]: i for i, r in enumerate(rows)}
    found = [r.asDict() | {"vec_id": ids[r["vec_id"]]} for r in queries.QUERIES["op13_spectrum_whitening"](spark, SF_DIR).collect()]
    check(found, [r["embedding"] for r in rows], 16)


def test_edges(spark):
    rng = np.random.default_rng(5)
    good = [list(map(float, v)) for v in rng.standard_normal((60, 5)) * [4, 2, 1, 1, 3]]
    good += [good[0]] * 30 + [[1e9, -1e9, 0.0, 5.0, 7.0]]  # copies count once; a far value
    bad = [None, [], [1.0, 2.0], [1.0, None, 1.0, 1.0, 1.0], [float("nan")] * 5, [1.0, 1.0, float("inf"), 1.0, 1.0]]
    rows = [(i, v, "c", 1) for i, v in enumerate(good)] + [(1000 + i, v, "c", 1) for i, v in enumerate(bad)]
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA), components=5)
    assert out.columns == ["vec_id", "embedding", "_p", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    found = out.collect()
    n, deviation, _, explained = brute(good, 5)
    kept = len({r["component"] for r in found})
    assert len(found) == len(good) * kept and {r["n"] for r in found} == {n}
    by_id = {r["vec_id"]: r["deviation"] for r in found}
    assert [by_id[i] for i in range(len(good))] == [d if d < 1 << 63 else None for d in deviation]
    check([r for r in whitening.whiten(spark.createDataFrame(rows[:90], SCHEMA), components=5).collect()], good[:90], 5)


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None, "c", 1)], [(1, [1.0, 2.0], "c", 1)] * 3):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_constant_dimension_and_null_ids(spark):
    rows = [(None, [float(i % 7), 3.0, float(i % 2)], "c", 1) for i in range(14)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 28 and {r["component"] for r in found} == {1, 2}


@pytest.mark.parametrize("values", [[3.0] * 4 + [2.0] * 4 + [1.0] * 24, list(1 + 1e-9 * np.arange(32)), list(np.arange(32.0)), [5.0] + [0.0] * 31])
def test_leading_of_close_and_equal_eigenvalues(values):
    d = len(values)
    q, _ = np.linalg.qr(np.random.default_rng(3).standard_normal((d, d)))
    v = (q * np.array(values)) @ q.T
    v = (v + v.T) / 2
    e, x = whitening.leading(v, 10)
    assert np.abs(e - np.sort(values)[::-1][:10]).max() < 1e-13 * max(values)
    assert np.abs(v @ x - x * e).max() < 1e-13 * max(values) and np.abs(x.T @ x - np.eye(10)).max() < 1e-13


def test_counts_are_the_inertia():
    v = np.random.default_rng(4).standard_normal((20, 20))
    v = v + v.T
    e = np.linalg.eigvalsh(v)
    for s in np.linspace(e[0] - 1, e[-1] + 1, 40):
        assert whitening.count_below(v, s) == int((e < s).sum())
    assert whitening.count_below(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


def test_sums_are_exact():
    y = np.array([[3 << 40, -5], [1 << 41, 1 << 20]], dtype="int64")
    assert whitening.exact_products(y).tolist() == [[sum(int(r[i]) * int(r[j]) for r in y) for j in range(2)] for i in range(2)]
