import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import versioning as v
from ledgerlake.sinks.versioned_dir import FactTable, ReportTable

SPEC = v.VersionSpec(keys=("k",), payload=("k", "a"), record_type="T")
S1 = v.LoadStamp("2024-01-01", "run", "2024-01-01 01:00:00")
S2 = v.LoadStamp("2024-02-01", "run", "2024-02-01 01:00:00")


def test_fact_table_versions_and_replay(spark, tmp_dir):
    t = FactTable(spark, tmp_dir + "/fact", SPEC)
    b1 = spark.createDataFrame([("1", "x"), ("2", "y")], "k string, a string")
    b2 = spark.createDataFrame([("2", "Y"), ("3", "z")], "k string, a string")
    assert t.load(b1, S1, batch_id=("s", 0)) == 0
    assert t.load(b2, S2, batch_id=("s", 1)) == 1
    assert t.load(b2, S2, batch_id=("s", 1)) is None  # replayed micro-batch
    assert t.current().count() == 3 and t.read().count() == 4
    assert {r["a"] for r in t.as_of("2024-01-15").collect()} == {"x", "y"}


def test_report_table_upsert(spark, tmp_dir):
    t = ReportTable(spark, tmp_dir + "/report", ["k"])
    t.upsert(spark.createDataFrame([("1", "x"), ("2", "y")], "k string, a string"), batch_id=("s", 0))
    t.upsert(spark.createDataFrame([("2", "Y"), ("2", "Y2")], "k string, a string"), batch_id=("s", 1))
    t.upsert(spark.createDataFrame([("9", "no")], "k string, a string"), batch_id=("s", 1))
    assert sorted(tuple(r) for r in t.read().collect()) == [("1", "x"), ("2", "Y"), ("2", "Y2")]


def test_publish_current_view(spark, tmp_dir):
    from ledgerlake.sinks.versioned_dir import publish_current_view

    t = FactTable(spark, tmp_dir + "/fact", SPEC)
    t.load(spark.createDataFrame([("1", "x"), ("2", "y")], "k string, a string"), S1)
    t.load(spark.createDataFrame([("2", "Y")], "k string, a string"), S2)
    view = publish_current_view(t, "fact_current", SPEC.columns)
    assert sorted((r["k"], r["a"]) for r in view.collect()) == [("1", "x"), ("2", "Y")]
    assert view.columns == SPEC.columns


def test_partitioned_fact_rewrites_only_touched_partitions(spark, tmp_dir):
    spec = v.VersionSpec(keys=("k",), payload=("k", "m", "a"), record_type="T")
    t = FactTable(spark, tmp_dir + "/pfact", spec, partition_expr="`m`")
    b1 = spark.createDataFrame([("1", "202401", "x"), ("2", "202402", "y"), ("3", "202403", "z")],
                               "k string, m string, a string")
    t.load(b1, S1)
    first = dict(t.log.latest()["current"])
    assert sorted(first) == ["__part=202401", "__part=202402", "__part=202403"]
    # key 2 moves from February to March; January is untouched
    b2 = spark.createDataFrame([("2", "202403", "Y"), ("4", None, "w")], "k string, m string, a string")
    t.load(b2, S2)
    cur = t.log.latest()["current"]
    assert cur["__part=202401"] == first["__part=202401"]
    assert "__part=202402" not in cur and cur["__part=202403"] != first["__part=202403"]
    rows = {r["k"]: (r["m"], r["a"]) for r in t.current().collect()}
    assert rows == {"1": ("202401", "x"), "2": ("202403", "Y"), "3": ("202403", "z"), "4": (None, "w")}
    assert t.read().count() == 5
    # same as an unpartitioned table
    u_ = FactTable(spark, tmp_dir + "/ufact", spec)
    u_.load(b1, S1)
    u_.load(b2, S2)
    assert sorted(map(tuple, u_.read().collect()), key=repr) == sorted(map(tuple, t.read().collect()), key=repr)


def test_partitioned_report_table(spark, tmp_dir):
    t = ReportTable(spark, tmp_dir + "/prep", ["k"], partition_expr="`m`")
    t.upsert(spark.createDataFrame([("1", "a", "x"), ("2", "b", "y"), ("2", "b", "y2")], "k string, m string, v string"))
    before = dict(t.log.latest()["current"])
    t.upsert(spark.createDataFrame([("2", "c", "Y")], "k string, m string, v string"))
    after = t.log.latest()["current"]
    assert after["__part=a"] == before["__part=a"] and "__part=b" not in after
    assert sorted(tuple(r) for r in t.read().collect()) == [("1", "a", "x"), ("2", "c", "Y")]


def test_key_that_moves_partition_has_one_current_row(spark, tmp_dir):
    spec = v.VersionSpec(keys=("k",), payload=("k", "m", "a"), record_type="T")
    t = FactTable(spark, tmp_dir + "/sfact", spec, partition_expr="`m`")
    t.load(spark.createDataFrame([("1", "202401", "x"), ("2", "202402", "y")], "k string, m string, a string"), S1)
    first = dict(t.log.latest()["current"])
    t.load(spark.createDataFrame([("2", "202403", "Y")], "k string, m string, a string"), S2)
    assert t.log.latest()["current"]["__part=202401"] == first["__part=202401"]
    assert sorted((r["k"], r["m"], r["a"]) for r in t.current().collect()) == [("1", "202401", "x"), ("2", "202403", "Y")]


def test_full_load_closes_only_its_scope(spark, tmp_dir):
    spec = v.VersionSpec(keys=("s", "k"), payload=("s", "k", "a"), record_type="T")
    t = FactTable(spark, tmp_dir + "/scoped", spec, full_scope=["s"])
    t.load(spark.createDataFrame([("x", "1", "a"), ("x", "2", "a"), ("y", "1", "a")], "s string, k string, a string"), S1)
    t.load(spark.createDataFrame([("x", "1", "a")], "s string, k string, a string"), S2, mode="full")
    marks = {(r["s"], r["k"]): r[v.DELETE] for r in t.current().collect()}
    assert marks == {("x", "1"): None, ("x", "2"): v.DELETE_MARK, ("y", "1"): None}
    with pytest.raises(ValueError):
        t.load(spark.createDataFrame([], "s string, k string, a string"), S2, mode="full")


def test_earlier_load_date_is_refused(spark, tmp_dir):
    t = FactTable(spark, tmp_dir + "/early", SPEC)
    t.load(spark.createDataFrame([("1", "a")], "k string, a string"), S2)
    with pytest.raises(ValueError):
        t.load(spark.createDataFrame([("1", "b")], "k string, a string"), S1)


def test_half_written_log_file_leaves_the_table_readable(spark, tmp_dir):
    t = ReportTable(spark, tmp_dir + "/crash", ["k"])
    t.upsert(spark.createDataFrame([("1", "a")], "k string, a string"))
    open(tmp_dir + "/crash/_log/.00000001-dead.tmp", "w").close()  # a writer that died before its rename
    assert [tuple(r) for r in t.read().collect()] == [("1", "a")]
    t.upsert(spark.createDataFrame([("1", "b")], "k string, a string"))
    assert [tuple(r) for r in t.read().collect()] == [("1", "b")]


def test_fact_schema_change_keeps_old_values(spark, tmp_dir):
    from pyspark.sql import types as T

    spec = v.VersionSpec(keys=("k",), payload=("k", "a", "n"), record_type="T")
    t = FactTable(spark, tmp_dir + "/efact", spec, partition_expr="`k`")
    t.load(spark.createDataFrame([("1", "x", "10"), ("2", "y", "bad")], "k string, a string, n string"), S1)
    cur = t.current()
    # drop "a", retype "n" to int
    target = T.StructType([f if f.name != "n" else T.StructField("n", T.IntegerType())
                           for f in cur.schema.fields if f.name != "a"])
    new_spec = v.VersionSpec(keys=("k",), payload=("k", "n"), record_type="T")
    t.evolve(target, new_spec)
    rows = {r["k"]: r.asDict() for r in t.current().collect()}
    assert rows["1"]["n"] == 10 and rows["1"]["n_legacy"] == "10" and rows["1"]["a_legacy"] == "x"
    assert rows["2"]["n"] is None and rows["2"]["n_legacy"] == "bad"
    # the same values again: no new version; a change: legacy values carried
    t.load(spark.createDataFrame([("1", 10), ("2", 5), ("3", 7)], "k string, n int"), S2)
    rows = {r["k"]: r.asDict() for r in t.current().collect()}
    assert rows["1"][v.VERSION] == 1 and rows["2"][v.VERSION] == 2 and rows["2"]["a_legacy"] == "y"
    assert rows["3"]["a_legacy"] is None and t.read().count() == 4


def test_report_schema_change(spark, tmp_dir):
    from pyspark.sql import types as T

    t = ReportTable(spark, tmp_dir + "/erep", ["k"], partition_expr="`m`")
    t.upsert(spark.createDataFrame([("1", "a", "x")], "k string, m string, v string"))
    t.evolve(T.StructType([T.StructField("k", T.StringType()), T.StructField("m", T.StringType())]))
    t.upsert(spark.createDataFrame([("2", "a")], "k string, m string").withColumn("v_legacy", F.lit(None).cast("string")))
    assert sorted(tuple(r) for r in t.read().collect()) == [("1", "a", "x"), ("2", "a", None)]


def test_commit_race_is_detected_and_retried(spark, tmp_dir):
    import pytest

    from ledgerlake.sinks.versioned_dir import CommitConflict

    t = FactTable(spark, tmp_dir + "/rfact", SPEC)
    t.load(spark.createDataFrame([("1", "x")], "k string, a string"), S1)
    stale = t.log.latest()
    other = FactTable(spark, tmp_dir + "/rfact", SPEC)
    other.load(spark.createDataFrame([("2", "y")], "k string, a string"), S2)  # wins version 1
    with pytest.raises(CommitConflict):
        t.log.commit(dict(stale, version=1))
    calls = {"n": 0}
    real = t.log.latest

    def first_stale():
        calls["n"] += 1
        return stale if calls["n"] == 1 else real()

    t.log.latest = first_stale  # this writer starts from the old version and loses the race once
    assert t.load(spark.createDataFrame([("3", "z")], "k string, a string"), S2) == 2
    assert sorted(r["k"] for r in t.current().collect()) == ["1", "2", "3"]


def test_as_of_reads_only_history_closed_after_the_day(spark, tmp_dir):
    t = FactTable(spark, tmp_dir + "/afact", SPEC)
    S3 = v.LoadStamp("2024-03-01", "run", "2024-03-01 01:00:00")
    t.load(spark.createDataFrame([("1", "x")], "k string, a string"), S1)
    t.load(spark.createDataFrame([("1", "y")], "k string, a string"), S2)
    t.load(spark.createDataFrame([("1", "z")], "k string, a string"), S3)
    entry = t.log.latest()
    assert sorted(closed for _, closed in entry["history"].values()) == ["2024-02-01", "2024-03-01"]
    for day, want in [("2024-01-15", "x"), ("2024-02-15", "y"), ("2024-03-15", "z")]:
        assert [r["a"] for r in t.as_of(day).collect()] == [want]
    files = t.as_of("2024-02-15").inputFiles()
    skipped = next(part for part, (_, closed) in entry["history"].items() if closed == "2024-02-01")
    assert not any(skipped in f for f in files)


def test_repeated_key_in_a_batch_gives_one_version(spark, tmp_dir):
    t = FactTable(spark, tmp_dir + "/dfact", SPEC)
    t.load(spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c")], "k string, a string"), S1)
    cur = {r["k"]: r["a"] for r in t.current().collect()}
    assert cur == {"1": "b", "2": "c"} and t.read().count() == 2


def test_full_refresh_of_one_source_leaves_the_others_alone(spark, tmp_dir):
    spec = v.VersionSpec(keys=("s", "k"), payload=("s", "k", "a"), record_type="T")
    t = FactTable(spark, tmp_dir + "/sources", spec, partition_expr="`s`", full_scope=["s"])
    t.load(spark.createDataFrame([(s, str(i), "a") for s in "wxyz" for i in range(3)], "s string, k string, a string"), S1)
    before = dict(t.log.latest()["current"])
    t.load(spark.createDataFrame([("x", "0", "a"), ("x", "1", "b"), ("x", "9", "n")], "s string, k string, a string"), S2, mode="full")
    after = t.log.latest()["current"]
    assert {p: f for p, f in after.items() if p != "__part=x"} == {p: f for p, f in before.items() if p != "__part=x"}
    assert after["__part=x"] != before["__part=x"]
    rows = {(r["s"], r["k"]): (r["a"], r[v.VERSION], r[v.DELETE]) for r in t.current().collect()}
    assert {k: x for k, x in rows.items() if k[0] == "x"} == {("x", "0"): ("a", 1, None), ("x", "1"): ("b", 2, None), ("x", "2"): ("a", 2, "Y"), ("x", "9"): ("n", 1, None)}
    assert all(rows[s, str(i)] == ("a", 1, None) for s in "wyz" for i in range(3))


def test_other_spellings_of_a_number_open_no_version(spark, tmp_dir):
    spec = v.VersionSpec(keys=("k",), payload=("k", "n"), record_type="T")
    t = FactTable(spark, tmp_dir + "/drift", spec)
    t.load(spark.createDataFrame([("1", "1.50"), ("2", "2.00")], "k string, n string").selectExpr("k", "CAST(n AS DECIMAL(15,2)) n"), S1)
    t.load(spark.createDataFrame([("1", "1.500"), ("2", "2.250")], "k string, n string").selectExpr("k", "CAST(n AS DECIMAL(20,3)) n"), S2)
    assert sorted((r["k"], str(r["n"]), r[v.VERSION]) for r in t.current().collect()) == [("1", "1.50", 1), ("2", "2.25", 2)]
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        t.load(spark.createDataFrame([("1", "1e14")], "k string, n string").selectExpr("k", "CAST(n AS DECIMAL(20,3)) n"), S2)


def test_last_rows(spark):
    rows = [("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), (None, 1, "n"), (None, 2, "m"), ("b", None, "only"), ("c", None, "first"), ("c", 0, "last")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    assert {r["k"]: r["v"] for r in v.last_rows(df, ["k"], ["o"]).collect()} == {"a": "z", None: "m", "b": "only", "c": "last"}
    plan = v.last_rows(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "max_by" not in plan and "Window" not in plan


def test_bucketed_table(spark, tmp_dir):
    from ledgerlake.sinks.bucketed import BucketedTable

    t = BucketedTable(spark, "bucketed_small", tmp_dir + "/b", ["a", "b"], buckets=4)
    shape = "a int, b string, c int"
    assert t.upsert(spark.createDataFrame([(1, "x", 1), (1, None, 2), (2, "x", 3), (None, None, 4), (2, "x", 33)], shape), ("r", 0)) == 0
    assert t.upsert(spark.createDataFrame([(1, None, 20), (1, None, 21), (None, None, 40), (3, "~", 5)], shape), ("r", 1)) == 1
    assert t.upsert(spark.createDataFrame([(1, None, 99)], shape), ("r", 1)) is None  # done before
    expected = [(1, "x", 1), (2, "x", 3), (2, "x", 33), (1, None, 20), (1, None, 21), (None, None, 40), (3, "~", 5)]
    assert sorted(map(tuple, t.read().collect()), key=repr) == sorted(expected, key=repr)
    assert t.upsert(spark.createDataFrame([], shape)) == 2 and t.read().count() == len(expected)
    t.upsert(spark.createDataFrame([(2, "x")], "a int, b string"))
    assert (2, "x", None) in set(map(tuple, t.read().collect())) and t.read().count() == len(expected) - 1
    with pytest.raises(ValueError):
        t.upsert(spark.createDataFrame([(2, 7)], "a int, d int"))
    again = BucketedTable(spark, "bucketed_small", tmp_dir + "/b", ["a", "b"], buckets=4)
    assert again.state()["version"] == 3 and again.state()["batches"] == {"r": 1}


def test_as_of_reads_only_parts_whose_interval_holds_the_day(spark, tmp_dir):
    """Four loads; key 1 changes each time, key 2 in the last only, key 3 never."""
    t = FactTable(spark, tmp_dir + "/intervals", SPEC)
    days = ["2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01"]
    for i, day in enumerate(days):
        t.load(spark.createDataFrame([("1", f"x{i}"), ("2", "y" if i < 3 else "Y"), ("3", "z")], "k string, a string"), v.LoadStamp(day, "run", f"{day} 01:00:00"))
    history = t.log.latest()["history"]
    assert sorted(history.values()) == sorted([[days[0], days[1]], [days[1], days[2]], [days[0], days[3]], [days[2], days[3]]])
    for i, day in enumerate(days):
        read = t.as_of(day)
        assert {r["k"]: r["a"] for r in read.collect()} == {"1": f"x{i}", "2": "y" if i < 3 else "Y", "3": "z"}
        parts = {p for p in history if any(p in f for f in read.inputFiles())}
        assert parts == {p for p, (a, b) in history.items() if a <= day < b} and len(parts) == (2 if i < 3 else 0)


def test_schema_change_rewrites_nothing_and_the_next_load_sees_real_changes(spark, tmp_dir):
    from pyspark.sql import types as T

    spec = v.VersionSpec(keys=("k",), payload=("k", "p", "a", "n"), record_type="T")
    t = FactTable(spark, tmp_dir + "/levels", spec, partition_expr="`p`")
    t.load(spark.createDataFrame([(k, p, "gone", n) for k, p, n in (("1", "x", "1"), ("2", "x", "2"), ("3", "y", "3"), ("4", "z", "bad"))], "k string, p string, a string, n string"), S1)
    before = t.log.latest()
    fields = T.StructType.fromJson(before["schema"]).fields
    new = v.VersionSpec(keys=("k",), payload=("k", "p", "n"), record_type="T")
    t.evolve(T.StructType([T.StructField(f.name, T.IntegerType() if f.name == "n" else f.dataType) for f in fields if f.name != "a"]), new)
    after = t.log.latest()
    assert after["current"] == before["current"] and after["history"] == before["history"]  # the log alone was written
    t = FactTable(spark, tmp_dir + "/levels", new, partition_expr="`p`")  # opened again
    t.load(spark.createDataFrame([("1", "x", 1), ("2", "x", 22), ("5", "w", 5)], "k string, p string, n int"), S2)
    now = t.log.latest()
    assert now["current"]["__part=y"] == before["current"]["__part=y"] and now["current"]["__part=x"] != before["current"]["__part=x"]
    rows = {r["k"]: (r["n"], r["n_legacy"], r["a_legacy"], r[v.VERSION]) for r in t.current().collect()}
    assert rows == {"1": (1, "1", "gone", 1), "2": (22, "2", "gone", 2), "3": (3, "3", "gone", 1), "4": (None, "bad", "gone", 1), "5": (5, None, None, 1)}
    assert t.read().count() == 6 and {r["k"] for r in t.as_of("2024-01-15").collect()} == {"1", "2", "3", "4"}
    t.load(spark.createDataFrame([("3", "y", 3), ("4", "z", None)], "k string, p string, n int"), v.LoadStamp("2024-03-01", "run", "2024-03-01 01:00:00"))
    assert {r[v.VERSION] for r in t.current().where("k IN ('3', '4')").collect()} == {1}


def _parts(root):
    """Wide parquet files under ``root``, scratch included: (folder below root, rows)."""
    import glob
    import os

    import pyarrow.parquet as pq
    return sorted((os.path.relpath(os.path.dirname(f), root), pq.ParquetFile(f).metadata.num_rows) for f in glob.glob(f"{root}/**/*.parquet", recursive=True))


def test_first_load_writes_its_rows_once(spark, tmp_dir, monkeypatch):
    """No copy of the batch beside the parts, and no shuffle of whole rows into few folders."""
    from ledgerlake.sinks import versioned_dir as vd

    monkeypatch.setattr(vd, "scratch_path", lambda _, name: f"{tmp_dir}/scratch/{name}")
    t = FactTable(spark, tmp_dir + "/fact", SPEC)
    t.load(spark.range(1000).selectExpr("CAST(id AS STRING) AS k", "'x' AS a"), S1)
    assert sum(n for _, n in _parts(tmp_dir)) == 1000
    assert t.current().count() == 1000


def test_repeated_keys_of_a_first_load(spark, tmp_dir):
    """The last row of each key, whole table or by partition; the order columns stay out of the table."""
    rows = [(str(i % 50), f"a{i:03d}", "p%d" % (i % 2)) for i in range(200)] + [(None, "n1", "p0"), (None, "n2", "p0")]
    spec = v.VersionSpec(keys=("k",), payload=("k", "a", "p"), record_type="T")
    for name, expr in (("whole", None), ("parts", "p")):
        t = FactTable(spark, f"{tmp_dir}/{name}", spec, partition_expr=expr)
        t.load(spark.createDataFrame(rows, "k string, a string, p string"), S1)
        got = {r["k"]: r["a"] for r in t.current().collect()}
        assert got == {**{str(i): f"a{i + 150:03d}" for i in range(50)}, None: "n2"} and t.current().count() == 51
        assert t.current().columns == spec.columns


def test_ids_and_hashes_go_through_a_load_unchanged(spark, tmp_dir):
    ids = ["ab" * 32, "AB" * 32, "abc", "", "00", "zz", "äb", None]
    df = spark.createDataFrame([(x,) for x in ids], "c string")
    from pyspark.sql import functions as F
    there = df.select(F.expr(v.packed("c")).alias("c"))
    assert [r["c"] for r in there.select(F.expr(v.unpacked("c")).alias("c")).collect()] == ids
    assert there.distinct().count() == len(ids) and max(len(r["c"]) for r in there.collect() if r["c"]) == 65
    spec = v.VersionSpec(keys=("k",), payload=("k", "a"), record_type="T", carry=("up",))
    t = FactTable(spark, tmp_dir + "/packed", spec)
    t.load(spark.createDataFrame([("1", "x", "ab" * 32), ("2", "y", "Zz"), ("3", "z", None)], "k string, a string, up string"), S1)
    t.load(spark.createDataFrame([("1", "X", "cd" * 32), ("4", "n", "AB")], "k string, a string, up string"), S2)
    assert sorted((r["k"], r["up"]) for r in t.current().collect()) == [("1", "cd" * 32), ("2", "Zz"), ("3", None), ("4", "AB")]
    assert all(len(r[v.HASH]) == 64 for r in t.read().collect())


def test_a_write_into_many_folders_makes_few_files(spark, tmp_dir):
    spec = v.VersionSpec(keys=("k",), payload=("k", "a"), record_type="T")
    t = FactTable(spark, tmp_dir + "/many", spec, partition_expr="a")
    t.load(spark.range(0, 4000, 1, 4).selectExpr("CAST(id AS STRING) AS k", "CAST(id % 40 AS STRING) AS a"), S1)
    assert len(_parts(tmp_dir + "/many")) == 40
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_a_merge_in_rounds_gives_the_same_table_and_leaves_no_scratch(spark, tmp_dir, monkeypatch):
    """Rows meet by parts of their keys, whatever a round's batch rows say of the scope; the written batch and replaced copies go."""
    import itertools
    import os

    from ledgerlake.sinks import versioned_dir as vd

    spec = v.VersionSpec(keys=("s", "k"), payload=("s", "k", "a"), record_type="T")
    number = itertools.count()
    monkeypatch.setattr(vd, "MOST_ROUNDS", 3)
    first = [("x", str(i), "a") for i in range(60)] + [("y", "1", "a"), ("x", None, "a"), ("x", "7", "b")]
    second = [("x", str(i), "b" if i % 3 else "a") for i in range(40, 80)] + [("x", None, "c")]
    monkeypatch.setattr(vd, "scratch_path", lambda _, name: f"{tmp_dir}/scratch/{name}-{next(number)}")
    os.makedirs(tmp_dir + "/scratch")
    for mode in ("delta", "full"):
        got = []
        for size in (1 << 30, 1):
            monkeypatch.setattr(vd, "ROUND_BYTES", size)
            calls = []
            merge = v.merge_prepared
            monkeypatch.setattr(vd.v, "merge_prepared", lambda *a, f=merge: calls.append(1) or f(*a))
            t = FactTable(spark, f"{tmp_dir}/{mode}{size}", spec, full_scope=["s"])
            t.load(spark.createDataFrame(first, "s string, k string, a string"), S1)
            t.load(spark.createDataFrame(second, "s string, k string, a string"), S2, mode=mode)
            monkeypatch.setattr(vd.v, "merge_prepared", merge)
            assert len(calls) == (vd.MOST_ROUNDS if size == 1 else 1)
            got.append(sorted(map(tuple, t.read().collect()), key=repr))
            assert len([d for d in os.listdir(f"{tmp_dir}/{mode}{size}") if d.startswith("load=0")]) == 1
        assert got[0] == got[1] and len(got[0]) > 80
    assert not [d for d in os.listdir(tmp_dir + "/scratch") if d.startswith("fact-batch")]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_a_refresh_of_whole_partitions_does_not_look_up_its_scope(spark, tmp_dir, monkeypatch):
    """The partitions read are those the batch speaks for: the current rows are not dealt by the scope, where all would meet in one task."""
    from ledgerlake.sinks import versioned_dir as vd

    spec = v.VersionSpec(keys=("s", "k"), payload=("s", "k", "a"), record_type="T")
    seen, merge = [], v.merge_prepared
    monkeypatch.setattr(vd.v, "merge_prepared", lambda *a: seen.append(a[5]) or merge(*a))
    got = []
    for name, expr in (("parts", "`s`"), ("whole", None)):
        t = FactTable(spark, f"{tmp_dir}/{name}", spec, partition_expr=expr, full_scope=["s"])
        t.load(spark.createDataFrame([(s, str(i), "a") for s in ("x", "y", None) for i in range(3)], "s string, k string, a string"), S1)
        t.load(spark.createDataFrame([("x", "0", "b"), (None, "1", "a")], "s string, k string, a string"), S2, mode="full")
        got.append(sorted(map(tuple, t.read().collect()), key=repr))
    assert seen == [(), ("s",)] and got[0] == got[1] and len(got[0]) == 9 + 5
