import datetime as dt
import hashlib


from ledgerlake.functions import delta_hash, iso_millis, na_to_null, row_id, strip_ws


def test_strip_all_unicode_space(spark):
    df = spark.createDataFrame([(" E1\t",), (" E1",), (" E1　",), ("   ",), (None,)], "c string")
    assert [r[0] for r in df.select(strip_ws("c")).collect()] == ["E1", "E1", "E1", "", None]


def test_na_words_become_null_blanks_stay(spark):
    df = spark.createDataFrame([("NA",), ("None",), ("null",), ("",), ("  ",), ("x",)], "c string")
    assert [r[0] for r in df.select(na_to_null("c")).collect()] == [None, None, None, None, "  ", "x"]


def test_iso_millis_truncates(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179999),)], "ts timestamp_ntz")
    assert df.select(iso_millis("ts")).first()[0] == "2024-01-01T00:00:07.179Z"


def test_hash_separates_fields_and_nulls(spark):
    rows = [("ab", "c"), ("a", "bc"), (None, "x"), ("x", None), ("", None), (None, "")]
    df = spark.createDataFrame(rows, "a string, b string")
    hashes = [r[0] for r in df.select(delta_hash(["a", "b"])).collect()]
    assert len(set(hashes)) == len(rows)
    expected = hashlib.sha256("2:ab|1:c".encode()).hexdigest()
    assert hashes[0] == expected


def test_row_id_null_for_missing_key(spark):
    df = spark.createDataFrame([("k",), (None,)], "k string")
    ids = [r[0] for r in df.select(row_id("LINE", ["k"])).collect()]
    assert ids[0] == hashlib.sha256("4:LINE|1:k".encode()).hexdigest() and ids[1] is None
    assert len(ids[0]) == 64
