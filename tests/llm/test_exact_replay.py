"""Exact dedup over several runs of one state folder."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import exact_dedup
from ledgerlake.session import scratch_path


def table(spark, rows):
    path = scratch_path(spark, "docs")
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(path)
    return path


def judged(df):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in df.collect()), key=str)


def test_a_repeated_run_changes_nothing(spark):
    folder, path = scratch_path(spark, "state"), table(spark, [(1, "a"), (2, "A"), (3, "b"), (4, None), (5, "")])
    first = judged(exact_dedup.dedup(spark, path, folder=folder))
    assert first == [(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True), (4, 5, 2, False), (5, 5, 2, True)]
    for _ in range(2):
        assert judged(exact_dedup.dedup(spark, path, folder=folder)) == first
    more = table(spark, [(9, "B"), (10, "c")])
    both = judged(exact_dedup.dedup(spark, more, folder=folder))
    assert both == sorted([(1, 2, 2, False), (2, 2, 2, True), (3, 9, 2, False), (4, 5, 2, False), (5, 5, 2, True), (9, 9, 2, True), (10, 10, 1, True)], key=str)
    assert judged(exact_dedup.dedup(spark, path, folder=folder)) == both  # an earlier table again


def test_a_run_that_died_behind_its_log_goes_on(spark, monkeypatch):
    folder, path = scratch_path(spark, "state"), table(spark, [(1, "a"), (2, "A")])
    take_in = exact_dedup.DigestState.take_in
    monkeypatch.setattr(exact_dedup.DigestState, "take_in", lambda self: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        exact_dedup.dedup(spark, path, folder=folder)
    monkeypatch.setattr(exact_dedup.DigestState, "take_in", take_in)
    assert judged(exact_dedup.dedup(spark, path, folder=folder)) == [(1, 2, 2, False), (2, 2, 2, True)]


def test_bytes_of_earlier_runs_are_compared(spark):
    """With a digest of one character, texts of two runs that differ meet under one digest."""
    folder = scratch_path(spark, "state")

    def weak(text):
        return F.substring(text, 1, 1)
    exact_dedup.dedup(spark, table(spark, [(1, "xa"), (2, "yy")]), folder=folder, digest=weak).collect()
    found = judged(exact_dedup.dedup(spark, table(spark, [(3, "xb"), (4, "XA"), (5, "YY")]), folder=folder, digest=weak))
    assert found == [(1, 4, 2, False), (2, 5, 2, False), (3, 3, 1, True), (4, 4, 2, True), (5, 5, 2, True)]
