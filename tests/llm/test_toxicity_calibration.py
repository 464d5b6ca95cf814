"""Toxicity: numbers of a text by hand, labels of equal texts, calibration on rows the trees have not seen."""

import math
import random
import zlib

import pytest

from ledgerlake.llm import toxicity


def test_features_by_hand():
    f = toxicity.Features({b"zlurp": 2.0, b"snar*": 1.5})
    got = f.of("You ZLURP, snarky idi0t! zlurp BAD")
    words = 6  # you zlurp snarky idi0t zlurp bad
    size = len("You ZLURP, snarky idi0t! zlurp BAD")
    expected = [math.log1p(words), 3 / words, math.log1p(3), 5.5 / words, math.log1p(5.5), 2.0, math.log1p(2), 2 / words, math.log1p(2), 0.0, 0.0,
                3 / words, 1.0, 9 / size, 2 / words, 2 / size, 1 / words, 1 / words, math.log1p(1)]
    assert got == pytest.approx(expected)
    assert f.of(None) == f.of("") == [0.0] * len(expected)


def test_equal_texts_are_toxic_if_any_label_says_so(spark):
    ids = [i for i in range(60) if not zlib.crc32(str(i).encode()) % 3 == 1]
    docs = spark.createDataFrame([(i, "same" if k % 2 else None) for k, i in enumerate(ids)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i == ids[1])) for i in ids] + [(ids[1], 0)], "doc_id long, toxic int")
    for parts in (1, 7):
        got = toxicity.labelled_texts(docs.repartition(parts), labels, "text", "doc_id", "toxic", 1000)
        assert {(r["text"], r["y"]) for r in got.collect()} == {("same", 1), ("", 0)}


def test_few_rows_without_a_pattern_are_not_called_toxic(spark):
    """Labels by chance, under 100 toxic ones: trees fit their own rows, but rows they have not seen show there is nothing to learn."""
    rng = random.Random(11)
    rows = [(i, " ".join(f"w{rng.randrange(40)}{'!' * rng.randrange(2)}" for _ in range(30))) for i in range(240)]
    labels = spark.createDataFrame([(i, int(rng.random() < 0.3)) for i, _ in rows], "doc_id long, toxic int")
    got = toxicity.judge(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect()
    assert sum(r["predicted"] for r in got) <= len(got) // 20


@pytest.mark.parametrize("toxic", [1, 2, 5])
def test_folds_of_one_kind(spark, toxic):
    rows = [(i, f"zlurp zlurp you {i}" if i < toxic else f"plain words {i}") for i in range(0, 30)]
    labels = spark.createDataFrame([(i, int(i < toxic)) for i, _ in rows], "doc_id long, toxic int")
    got = toxicity.judge(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect()
    assert len(got) == 30 and all(0 <= r["score"] <= 1 for r in got)
