"""Spelling variants against a brute-force version over all pairs of words."""

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import queries, spelling

SF_DIR = "/root/testdata/sf0.001"


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def brute(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    n = {w: c for w, c in counts.items() if c >= 2 and len(w) >= 7}
    # Words of one edit share their first or second half, up to one place: only these are compared.
    halves = {}
    for w in n:
        for key in {("a", w[:3]), ("b", w[-3:])}:
            halves.setdefault(key, []).append(w)
    near = {w: set() for w in n}
    for group in halves.values():
        for w in group:
            near[w].update(v for v in group if abs(len(v) - len(w)) <= 1 and one_edit(w, v))
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {w: (form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def rows(df):
    found = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r["word"] for r in found}) == len(found)
    return {r["word"]: tuple(r)[1:] for r in found}


def test_query_against_brute_force(spark):
    docs = [tuple(r) for r in queries.documents(spark, SF_DIR).select("doc_id", "text").collect()]
    expected = brute(docs)
    assert rows(queries.QUERIES["op12_spelling_variants"](spark, SF_DIR)) == expected
    assert sum(r[3] > 0 for r in expected.values()) > 100


def test_chains_ties_and_edges(spark):
    long = "ab" * 2000
    text = ["wordings " * 3000, "wordingt " * 300, "wordinxt " * 30, "wordixxt", "wordixxt"]
    docs = [(1000 + i, t) for i, t in enumerate(text)] + [(None, "nullname nullname"), (7, None), (8, ""), (9, "Àltered àltered " * 3), (9, "Àltered àltered " * 3)]
    docs += [(20 + i, long) for i in range(3)] + [(50 + i, long[:3000] + "z" + long[3000:]) for i in range(50)]
    docs += [(100 + i, "tiewords " * 2) for i in range(1)] + [(101, "tieworda " * 40), (102, "tiewordb " * 40)]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, word string, n int")
    found = rows(spelling.variants(frame))
    assert found == brute(docs)
    assert found["tiewords"][0] == "tieworda"
    assert found["wordixxt"][:2] == ("wordinxt", "wordings")
    assert found[long][2] == 3 and found[long][0] == long[:3000] + "z" + long[3000:]


def test_empty(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("k", [2, 3])
def test_neighbourhood_is_complete(k):
    """Every two reduced words within one edit meet exactly once (equal ones from both sides)."""
    words = [w for n in (1, 2, 3, 4) for w in itertools.product(range(1, k + 1), repeat=n)]
    met = Counter()
    by_key = {}
    for w in words:
        by_key.setdefault(int(spelling.own_keys(np.array([w], "uint64"))[0]), []).append(w)
    assert all(len(ws) == 1 for ws in by_key.values())
    for w in words:
        keys, sent = spelling.neighbour_keys(np.array([w], "uint64"), k)
        met.update((min(w, v), max(w, v)) for key in keys[sent] for v in by_key.get(int(key), []))
    assert met == {(w, v): 1 for w, v in itertools.combinations_with_replacement(sorted(words), 2) if w == v or one_edit(w, v)}
