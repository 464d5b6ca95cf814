import random
from decimal import Decimal as D

import pandas as pd

from ledgerlake.operators import versioning as v
from ledgerlake.operators.sequence import sequence_by_key

SPEC = v.VersionSpec(keys=("k",), payload=("k", "a", "b"), record_type="T")
S1 = v.LoadStamp("2024-01-01", "run", "2024-01-01 01:00:00")
S2 = v.LoadStamp("2024-02-01", "run", "2024-02-01 01:00:00")
S3 = v.LoadStamp("2024-03-01", "run", "2024-03-01 01:00:00")
SCHEMA = "k string, a string, b decimal(15,2)"


def _first(spark):
    return spark.createDataFrame([("1", "x", D(1)), ("2", "y", D(2)), ("3", "z", D(3))], SCHEMA)


def _second(spark):
    # 1 unchanged, 2 changed, 3 missing, 4 new
    return spark.createDataFrame([("1", "x", D(1)), ("2", "Y", D(2)), ("4", "w", D(4))], SCHEMA)


def _by_key(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["k"], []).append(r)
    for k in out:
        out[k].sort(key=lambda r: r[v.VERSION])
    return out


def _check_invariants(fact):
    rows = _by_key(fact)
    for k, versions in rows.items():
        assert sum(1 for r in versions if r[v.CURRENT]) == 1, k
        assert [r[v.VERSION] for r in versions] == list(range(1, len(versions) + 1))
        for a, b in zip(versions, versions[1:]):
            assert a[v.VALID_TO] == b[v.VALID_FROM]


def test_delta_merge_cases(spark):
    fact1 = v.initial_load(spark, _first(spark), SPEC, S1)
    fact2 = v.versioned_merge(fact1, _second(spark), SPEC, S2)
    rows = _by_key(fact2)
    assert [r[v.VERSION] for r in rows["1"]] == [1]
    assert [(r[v.VERSION], r[v.CURRENT], r["a"]) for r in rows["2"]] == [(1, False, "y"), (2, True, "Y")]
    assert str(rows["2"][0][v.VALID_TO]) == "2024-02-01" and rows["2"][1][v.CREATED_AT] == rows["2"][0][v.CREATED_AT]
    assert [(r[v.VERSION], r[v.CURRENT]) for r in rows["3"]] == [(1, True)]
    assert [(r[v.VERSION], r[v.CURRENT]) for r in rows["4"]] == [(1, True)]
    _check_invariants(fact2)


def test_same_batch_again_changes_nothing(spark):
    fact1 = v.initial_load(spark, _first(spark), SPEC, S1)
    fact2 = v.versioned_merge(fact1, _second(spark), SPEC, S2)
    fact3 = v.versioned_merge(fact2, _second(spark), SPEC, S3)
    assert sorted(map(tuple, fact3.collect()), key=repr) == sorted(map(tuple, fact2.collect()), key=repr)


def test_full_refresh_marks_missing_and_returning_keys(spark):
    fact1 = v.initial_load(spark, _first(spark), SPEC, S1)
    fact2 = v.versioned_merge(fact1, _second(spark), SPEC, S2, mode="full")
    rows = _by_key(fact2)
    assert [(r[v.VERSION], r[v.CURRENT], r[v.DELETE]) for r in rows["3"]] == [(1, False, None), (2, True, "Y")]
    again = v.versioned_merge(fact2, _second(spark), SPEC, S3, mode="full")
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, fact2.collect()), key=repr)
    back = v.versioned_merge(fact2, _first(spark), SPEC, S3, mode="delta")
    r3 = _by_key(back)["3"]
    assert [(r[v.VERSION], r[v.CURRENT], r[v.DELETE]) for r in r3][-1] == (3, True, None)
    _check_invariants(back)


def test_classify_changes_partitions_keys(spark):
    fact1 = v.initial_load(spark, _first(spark), SPEC, S1)
    got = {r["k"]: r["change"] for r in v.classify_changes(fact1, _second(spark), SPEC).collect()}
    assert got == {"1": "unchanged", "2": "changed", "3": "missing", "4": "new"}


def test_as_of(spark):
    fact1 = v.initial_load(spark, _first(spark), SPEC, S1)
    fact2 = v.versioned_merge(fact1, _second(spark), SPEC, S2)
    jan = {r["k"]: r["a"] for r in v.as_of(fact2, "2024-01-15").collect()}
    feb = {r["k"]: r["a"] for r in v.as_of(fact2, "2024-02-15").collect()}
    assert jan == {"1": "x", "2": "y", "3": "z"} and feb == {"1": "x", "2": "Y", "3": "z", "4": "w"}


def test_latest_per_key_keeps_last(spark):
    df = spark.createDataFrame([("1", 1, "a"), ("1", 3, "c"), ("1", 2, "b"), (None, 1, "n")], "k string, o int, v string")
    got = {r["k"]: r["v"] for r in v.latest_per_key(df, ["k"], ["o"]).collect()}
    assert got == {"1": "c", None: "n"}


def test_sequence_matches_pandas_on_skewed_keys(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", None])
        rows.append((key, rnd.randint(0, 500), i))
    df = spark.createDataFrame(rows, "k string, t int, id int")
    got = sequence_by_key(df, ["k"], ["t", "id"], carry=["t"], slices=7)
    got = {r["id"]: (r["seq"], r["next_t"]) for r in got.collect()}
    pdf = pd.DataFrame(rows, columns=["k", "t", "id"]).fillna({"k": "<null>"}).sort_values(["k", "t", "id"])
    pdf["seq"] = pdf.groupby("k").cumcount() + 1
    pdf["next_t"] = pdf.groupby("k")["t"].shift(-1)
    expected = {int(r.id): (int(r.seq), None if pd.isna(r.next_t) else int(r.next_t)) for r in pdf.itertuples()}
    assert got == expected


def test_version_chain(spark):
    df = spark.createDataFrame([(1, 10, "a"), (1, 5, "b"), (2, 7, "c")], "u int, ts int, id string")
    got = {r["id"]: (r["version_number"], r["valid_to"], r["is_current"])
           for r in v.version_chain(df, ["u"], "ts", "id").collect()}
    assert got == {"b": (1, 10, False), "a": (2, None, True), "c": (1, None, True)}


def test_sequence_with_many_slices(spark):
    rows = [("k" if i % 2 else None, i % 97, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, t int, id int")
    got = {r["id"]: r["seq"] for r in sequence_by_key(df, ["k"], ["t", "id"], slices=500).collect()}
    expected = {}
    for key in ("k", None):
        ordered = sorted((t, i) for k, t, i in rows if k == key)
        expected.update({i: n + 1 for n, (_, i) in enumerate(ordered)})
    assert got == expected
