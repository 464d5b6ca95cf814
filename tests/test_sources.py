import os

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.clean import Lookups
from ledgerlake.operators.registry import clean_report, report
from ledgerlake.sources import lookups as lk
from ledgerlake.sources import pages as pg
from ledgerlake.sources import windows as win


def test_csv_na_words_and_blanks(spark, tmp_dir):
    path = os.path.join(tmp_dir, "codes.csv")
    with open(path, "w") as f:
        f.write('Expense Code,Desc\nNA,a\nNone,b\nnull,c\n,d\n  ,e\n\tE1 ,f\n')
    df = lk.read_lookup_csv(spark, path, ["Expense Code", "Desc"])
    got = {r["Desc"]: r["Expense Code"] for r in df.collect()}
    assert got == {"a": None, "b": None, "c": None, "d": None, "e": "  ", "f": "\tE1 "}
    pub = {r["Expense Code"] for r in lk.publish_lookup(df, "Expense Code").collect()}
    assert pub == {"", "E1"}
    assert lk.path_size_bytes(spark, path) > 0


def test_unknown_currency_and_report(spark):
    pages = spark.createDataFrame([("r", 0, [1])], "report string, page long, resultSet array<int>")
    with pytest.raises(ValueError):
        pg.page_rows(pages, "JPY")
    with pytest.raises(ValueError):
        report("Reporting API - nothing")
    with pytest.raises(ValueError):
        clean_report("nope", pages, Lookups(pages, pages))


def test_windows_half_open(spark):
    df = spark.createDataFrame([("2024-03-25 00:00:00",), ("2024-01-01 00:00:00",), ("2023-12-31 23:59:59",)],
                               "ts string").select(F.col("ts").cast("timestamp_ntz").alias("ts"))
    got = [str(r[0]) for r in win.rolling_window(df, "ts", "2024-03-25 00:00:00").collect()]
    assert got == ["2024-01-01 00:00:00"]
    got = [str(r[0]) for r in win.fixed_start_window(df, "ts", "2023-12-31 23:59:59", "2024-03-26").collect()]
    assert sorted(got) == ["2023-12-31 23:59:59", "2024-01-01 00:00:00", "2024-03-25 00:00:00"]
