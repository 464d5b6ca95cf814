import json
import os

from ledgerlake.sources import pages as pg


def _audit(spark, pages, page_size=5000):
    """``pages``: (page, asked, next, rows) of one session."""
    counts = spark.createDataFrame([("r", "s", *p) for p in pages], "report string, session string, page long, asked string, next string, n_rows int")
    rows = pg.audit_chains(counts, page_size).collect()
    assert len(rows) == 1
    return rows[0]


def test_page_chain_statuses(spark):
    first, second, third = (1, None, "b", 5000), (2, "b", "c", 5000), (3, "c", "d", 7)
    assert _audit(spark, [first, second, third]).status == "complete"
    assert _audit(spark, [first, second]).status == "truncated"
    assert _audit(spark, [first]).status == "truncated"
    assert _audit(spark, [first, second, (3, "c", "d", 0)]).status == "complete"
    assert _audit(spark, [second, third]).status == "missing_start"  # the first page was lost
    assert _audit(spark, [first, first, second, third]).status == "duplicate"  # a page landed twice
    assert _audit(spark, [first, third]).status == "broken"  # a page in the middle was lost
    assert _audit(spark, [(1, None, "b", 10), second, third]).status == "broken"  # a short page with a successor
    assert _audit(spark, [(1, None, None, 5000)]).status == "truncated"  # full, but names no next page
    assert _audit(spark, [(1, None, None, 3)]).status == "complete"


def test_oversize_page_is_complete_and_reported(spark):
    row = _audit(spark, [(1, None, "b", 7000)])
    assert (row.status, row.oversize, row.largest_page, row.n_rows) == ("complete", True, 7000, 7000)
    assert not _audit(spark, [(1, None, "b", 12)]).oversize


def test_sessions_do_not_help_each_other(spark):
    counts = spark.createDataFrame([("r", "s", 1, None, "b", 5000), ("r", "t", 2, "b", "c", 3), ("q", "s", 2, "b", "c", 3), (None, None, 1, None, "x", 1)],
                                   "report string, session string, page long, asked string, next string, n_rows int")
    found = {(r.report, r.session): r.status for r in pg.audit_chains(counts).collect()}
    assert found == {("r", "s"): "truncated", ("r", "t"): "missing_start", ("q", "s"): "missing_start", (None, None): "complete"}


def test_pages_with_different_columns_union(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(2, "y")], "a int, c string")
    out = pg.union_pages([a, b])
    assert out.columns == ["a", "b", "c"]
    assert sorted(map(tuple, out.collect()), key=repr) == [(1, "x", None), (2, None, "y")]


def test_read_landed_json_pages(spark, tmp_dir):
    for i, rows in enumerate([[{"Line ID": "1", "Role": "A"}, {"Line ID": "2", "Role": None}], []]):
        with open(os.path.join(tmp_dir, f"page-{i}.json"), "w") as f:
            json.dump({"resultSet": rows, "paging": {"sessionId": "s", "identifier": str(i + 1)}, "report": "r",
                       "pagingIdentifier": str(i) if i else None, "page": i + 1}, f, indent=2)
    schema = spark.createDataFrame([], "`Line ID` string, Role string").schema
    pages = pg.read_pages(spark, tmp_dir, schema, multi_line=True)
    assert sorted(r["n_rows"] for r in pg.page_counts(pages).collect()) == [0, 2]
    rows = pg.page_rows(pages, "USD").collect()
    assert sorted(r["Line ID"] for r in rows) == ["1", "2"] and {r["currency"] for r in rows} == {"USD"}


def test_incomplete_chain_raises_and_lists_all(spark):
    import pytest

    from ledgerlake.operators.report_load import IncompletePages, check_chains

    rows = [([1] * 5000, ("s1", "2"), None, "r", 1), ([1] * 3, ("s2", "2"), None, "r", 1), ([1], ("s3", "3"), "2", "r", 2)]
    pages = spark.createDataFrame(rows, "resultSet array<int>, paging struct<sessionId: string, identifier: string>, pagingIdentifier string, report string, page long")
    with pytest.raises(IncompletePages, match="chains: 2, listed in (.*)") as e:
        check_chains(pages)
    listed = spark.read.parquet(str(e.value).split(" listed in ")[1]).collect()
    assert {(r.session, r.status) for r in listed} == {("s1", "truncated"), ("s3", "missing_start")}
    assert check_chains(pages.where("paging.sessionId = 's2'")).count() == 1


def test_audit_plan_spreads_by_page_name(spark):
    """No window and no join: two hash aggregates, the first keyed by chain and page name."""
    pages = spark.createDataFrame([([1], ("s", "2"), None, "r", 1)],
                                  "resultSet array<int>, paging struct<sessionId: string, identifier: string>, pagingIdentifier string, report string, page long")
    plan = pg.audit_chains(pg.page_counts(pages))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and plan.count("Exchange hashpartitioning") == 2


def test_audit_tasks_follow_the_pages(spark, monkeypatch):
    """Twice the pages, twice the tasks that count by name, whatever the shuffle partitions; same chains."""
    counts = spark.range(4000).selectExpr("'r' AS report", "CAST(id % 40 AS STRING) AS session", "id div 40 + 1 AS page",
                                          "IF(id < 40, NULL, CAST(id div 40 AS STRING)) AS asked", "CAST(id div 40 + 1 AS STRING) AS next", "2 AS n_rows")
    want = sorted(map(str, pg.audit_chains(counts, 2).collect()))
    monkeypatch.setattr(pg, "NAMES_PER_TASK", 100)
    for rows, tasks in ((counts.where("page <= 50"), 40), (counts, 80)):
        plan = pg.audit_chains(rows, 2)._jdf.queryExecution().executedPlan().toString()
        assert f", {tasks}), REPARTITION_BY_NUM" in plan
    assert sorted(map(str, pg.audit_chains(counts, 2).collect())) == want
