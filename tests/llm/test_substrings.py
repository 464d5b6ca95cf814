"""Substring dedup: brute force over made-up documents, scripts without blanks, edge cases, and its SQL on the test tables."""

import random
import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from compare import compare, duck_connect
from ledgerlake.llm import substring_dedup

SF_DIR = "/root/testdata/sf0.001"
BLANK = "[\\x20\\x09-\\x0d]+"


def brute(docs, min_words=30):
    """{id: (text, removed, dup_of, n_removed)}, ids distinct and not null."""
    pieces, first = {}, {}
    for i, text in sorted(docs):
        at, out = 0, []
        for p in re.findall("[^.?\u3002\n]*[.?\u3002\n]+|[^.?\u3002\n]+", text or ""):
            words = [w for w in re.split(BLANK, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in p)) if w]
            if words:
                u = " ".join(words)
                out.append((at, at + len(p), u, len(u) // 5 if len(u) > 16 * len(words) else len(words)))
                first.setdefault(u, (i, len(out) - 1))
            at += len(p)
        pieces[i] = out
    result = {}
    for i, text in docs:
        runs, last = [], None
        for r, (s, e, u, n) in enumerate(pieces[i]):
            d, f = first[u]
            if (d, f) == (i, r):
                last = None
                continue
            if last == (d, f - 1):
                runs[-1][1:] = [e, runs[-1][2] + n, runs[-1][3] + 1, runs[-1][4]]
            else:
                runs.append([s, e, n, 1, d])
            last = (d, f)
        runs = [x for x in runs if x[2] >= min_words]
        kept, at = "", 0
        for s, e, *_ in runs:
            kept, at = kept + text[at:s], e
        result[i] = (text if not runs else kept + text[at:], ",".join(f"{s}-{e}" for s, e, *_ in runs), min((x[4] for x in runs), default=None), sum(x[3] for x in runs))
    return result


def run(df, **options):
    return {r["doc_id"]: (r["text"], r["removed"], r["dup_of"], r["n_removed"]) for r in substring_dedup.dedup_substrings(df, **options).collect()}


def test_against_brute_force(spark):
    rng = random.Random(4)
    sentences = [" ".join(rng.choice("red blue stone river über Tal x".split()) for _ in range(rng.randint(1, 14))) + rng.choice([".", "!", "?", "...", "\n", ".\n\n"]) for _ in range(60)]
    docs = []
    for i in range(150):
        text = ""
        while rng.random() < 0.8:
            if rng.random() < 0.5:  # a passage that others have too
                a = rng.randrange(55)
                text += " ".join(sentences[a:a + rng.randint(2, 9)])
            else:
                text += " ".join(str(rng.random())[2:9] for _ in range(rng.randint(1, 40))) + ". "
        docs.append((i, text))
    expected = brute(docs)
    assert run(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)) == expected
    assert sum(r[3] > 0 for r in expected.values()) > 20 and sum(r[3] == 0 for r in expected.values()) > 20


def test_query_against_sql_and_brute_force(spark):
    name = "op2_line_hash_dedup"
    res = compare(spark, duck_connect(SF_DIR), name, entry.queries()[name], entry.oracle_sql()[name], SF_DIR)
    assert res["ok"], res
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    found = {r["doc_id"]: (r["text"], r["removed"], r["dup_of"], r["n_removed"]) for r in entry.queries()[name](spark, SF_DIR).collect()}
    assert found == brute(docs)


def test_scripts_without_blanks(spark):
    line = "".join(chr(0x4E00 + i) for i in range(200))
    found = run(spark.createDataFrame([(i, line + "\n" + str(i)) for i in range(3)], "doc_id long, text string"))
    assert found == {0: (line + "\n0", "", None, 0), 1: ("1", "0-201", 0, 1), 2: ("2", "0-201", 0, 1)}


def test_edges(spark):
    passage = "One short sentence. " + "Another sentence of seven words here now. And one more of them, to be long enough. " + " ".join(f"w{i}" for i in range(25)) + "."
    rows = [(1, passage, "a"), (2, None, "a"), (3, "", "a"), (None, "Before. " + passage, "a"), (4, "\n \n\t", "a"), (5, passage.upper().replace(" ", "  "), "a"), (5, passage.upper().replace(" ", "  "), "a"),
            (6, "One short sentence.", "a"), (7, "x" * 2_000_000, "a"), (8, "Own words. " + passage + " Own end.", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, removed string").withColumns({c: F.lit("mine") for c in ("_doc", "_tie", "_runs", "n", "from")})
    out = substring_dedup.dedup_substrings(df)
    assert sorted(out.columns) == sorted(["doc_id", "text", "_doc", "_tie", "_runs", "n", "from", "n_removed", "removed", "dup_of"])
    found = out.collect()
    assert len(found) == len(rows) and {r["_doc"] for r in found} == {"mine"}
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[None]["n_removed"] == 0  # a null id comes first
    assert by_id[1]["text"] == "" and by_id[1]["dup_of"] is None and by_id[1]["n_removed"] == 4
    assert [r["text"] for r in found if r["doc_id"] == 5] == ["", ""]  # equal rows share their fate
    assert by_id[8]["text"] == "Own words. Own end." and by_id[8]["removed"] == f"10-{11 + len(passage)}"
    assert by_id[2]["text"] is None and by_id[3]["text"] == "" and by_id[4]["text"] == "\n \n\t" and by_id[6]["n_removed"] == 0 and len(by_id[7]["text"]) == 2_000_000
    assert substring_dedup.dedup_substrings(df.where("false")).count() == 0


def test_single_pieces_that_repeat_by_chance_stay(spark):
    docs = [(i, f"All rights reserved.\nText number {i} is its own. Thank you.") for i in range(5)]
    assert all(r[3] == 0 for r in run(spark.createDataFrame(docs, "doc_id long, text string")).values())
