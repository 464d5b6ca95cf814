import random

import pandas as pd

from ledgerlake.operators.joins import merge


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_null_meets_null_and_repeated_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, k string")
    look = spark.createDataFrame([("a", "A1"), ("a", "A2"), (None, "N"), ("z", "Z")], "k string, g string")
    out = merge(left, look, ["k"], "left", bounded=True)
    assert _rows(out, ["id", "k", "g"]) == sorted(
        [(1, "a", "A1"), (1, "a", "A2"), (2, None, "N"), (3, "b", None)], key=repr)


def test_unused_lookup_row_only_in_full_join(spark):
    left = spark.createDataFrame([(1, "a")], "id int, k string")
    look = spark.createDataFrame([("a", "A"), ("z", "Z")], "k string, g string")
    assert _rows(merge(left, look, ["k"], "left"), ["id", "k", "g"]) == [(1, "a", "A")]
    assert _rows(merge(left, look, ["k"], "full"), ["id", "k", "g"]) == sorted(
        [(1, "a", "A"), (None, "z", "Z")], key=repr)


def test_clashing_names_get_suffixes(spark):
    left = spark.createDataFrame([(1, "a", 10)], "id int, k string, v int")
    right = spark.createDataFrame([("a", 20)], "k string, v int")
    out = merge(left, right, ["k"], "left")
    assert out.columns == ["id", "k", "v_x", "v_y"]
    assert out.first()["v_y"] == 20


def test_full_merge_matches_pandas_outer_merge(spark):
    rnd = random.Random(7)
    keys = ["a", "b", "c", None]
    left = [(i, rnd.choice(keys)) for i in range(40)]
    right = [(rnd.choice(keys + ["d"]), f"g{i}") for i in range(12)]
    lp = pd.DataFrame(left, columns=["id", "k"])
    rp = pd.DataFrame(right, columns=["k", "g"])
    expected = pd.merge(lp, rp, on=["k"], how="outer")
    expected = sorted(
        (tuple(None if pd.isna(x) else x for x in r) for r in expected[["id", "k", "g"]].itertuples(index=False)),
        key=repr)
    expected = [(None if i is None else int(i), k, g) for i, k, g in expected]
    ls = spark.createDataFrame(left, "id int, k string")
    rs = spark.createDataFrame(right, "k string, g string")
    assert _rows(merge(ls, rs, ["k"], "full"), ["id", "k", "g"]) == sorted(expected, key=repr)


def test_hot_key_full_merge_and_upsert(spark):
    from ledgerlake.operators import upsert as u

    # one key holds a third of all rows, plus a hot null key
    rows = [(i, "hot" if i % 3 == 0 else (None if i % 7 == 0 else f"k{i % 50}")) for i in range(3000)]
    left = spark.createDataFrame(rows, "id int, k string")
    look = spark.createDataFrame([("hot", "H"), (None, "N"), ("k1", "K"), ("zz", "Z")], "k string, g string")
    out = merge(left, look, ["k"], "full")
    expected_rows = len(rows) + 1  # every left row once, plus the unused "zz"
    assert out.count() == expected_rows
    assert out.filter("k = 'hot'").count() == 1000 and out.filter("k IS NULL").select("g").distinct().collect()[0][0] == "N"
    batch = spark.createDataFrame([(-1, "hot"), (-2, None)], "id int, k string")
    kept = u.upsert(left, batch, ["k"])
    assert kept.filter("k = 'hot'").count() == 1 and kept.filter("k IS NULL").count() == 1
    assert kept.count() == len(rows) - 1000 - sum(1 for _, k in rows if k is None) + 2


def test_many_look_up_rows_without_a_key_count_as_one(spark):
    from ledgerlake.operators.joins import merge, one_null_row

    left = spark.range(1000).selectExpr("id", "IF(id % 2 = 0, NULL, CAST(id % 5 AS STRING)) AS k")
    look = spark.range(500).selectExpr("IF(id < 400, NULL, CAST(id % 5 AS STRING)) AS k", "CAST(500 - id AS STRING) AS a", "id AS b")
    one = one_null_row(look, "k")
    assert one.columns == look.columns and one.where("k IS NULL").collect()[0]["a"] == "101"  # the smallest as text
    assert one.count() == 101 and merge(left, one, ["k"], "left").where("k IS NULL").count() == 500
    assert one_null_row(look.where("k IS NOT NULL"), "k").count() == 100  # none, none added
    assert one_null_row(look.where("false"), "k").count() == 0
