"""Tables as versioned parquet folders with an atomic switch.

Plain parquet has no transactions, and overwriting a folder the plan is
reading fails half-way. Each commit therefore writes new, immutable parts
and then one small log file ``_log/<version>.json`` that lists the parts
making up that version (plus the schema and the last stream batch). The log
file is written under another name, closed, and renamed; the rename is the
commit point. Readers take the highest log file, a crashed writer leaves only
unreferenced parts or a file that no reader looks at, and the previous
versions stay readable as the back-up. Where the file system's rename is not
atomic or may overwrite, a table has one writer at a time.

Layouts:

* report tables (:class:`ReportTable`): delete-by-key + append; the whole
  table per version, or with a partition expression only the partitions
  the batch touches;
* versioned facts (:class:`FactTable`): closed history is append-only (parts
  of one opening and one closing day, never rewritten); current rows sit in
  partition folders, and a load reads and rewrites only the partitions it
  touches. A schema change writes the log only.

All paths go through the Hadoop file system of the root, so the same code
runs on HDFS or an object store.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators import upsert as u
from ledgerlake.operators.evolve import evolve
from ledgerlake.functions.hashing import delta_hash
from ledgerlake.operators.joins import key_match
from ledgerlake.operators import versioning as v
from ledgerlake.session import CLEANUP, CODEC, scratch_path, settings


class CommitConflict(RuntimeError):
    """Another writer committed the same version first."""


def _stage(prefix: str, version: int) -> str:
    """A fresh folder per write attempt: writers racing for one version never
    share (and never overwrite) each other's parts."""
    return f"{prefix}={version}-{uuid.uuid4().hex[:12]}"


class TableLog:
    """Ordered commit log of a table folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._log_dir = self._Path(f"{self.root}/_log")
        self._fs = self._log_dir.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def latest(self) -> dict | None:
        versions = self.versions()
        return self._read(versions[-1]) if versions else None

    def _read(self, version: int) -> dict:
        stream = self._fs.open(self._Path(f"{self.root}/_log/{version:08d}.json"))
        try:
            reader = self.spark.sparkContext._jvm.java.io.BufferedReader(
                self.spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            text = []
            line = reader.readLine()
            while line is not None:
                text.append(line)
                line = reader.readLine()
        finally:
            stream.close()
        return json.loads("\n".join(text))

    def commit(self, entry: dict) -> None:
        """Write the log file of ``entry['version']`` beside its place and
        rename it; raises :class:`CommitConflict` if that version exists
        (another writer committed it first)."""
        path = self._Path(f"{self.root}/_log/{entry['version']:08d}.json")
        draft = self._Path(f"{self.root}/_log/.{entry['version']:08d}-{uuid.uuid4().hex}.tmp")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(entry, sort_keys=True).encode("utf-8")))
        finally:
            out.close()
        if self._fs.exists(path) or not self._fs.rename(draft, path):
            self._fs.delete(draft, False)
            raise CommitConflict(f"version {entry['version']} of {self.root} was committed by another writer")

    def versions(self) -> list[int]:
        if not self._fs.exists(self._log_dir):
            return []
        names = [st.getPath().getName() for st in self._fs.listStatus(self._log_dir)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def part_path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        return bool(self._fs.exists(self._Path(self.part_path(name))))

    def size(self, path: str) -> int:
        return self._fs_of(path).getContentSummary(self._Path(path)).getLength()

    def remove(self, path: str) -> None:
        """Removes a folder that no log names: scratch, or parts that were written again."""
        self._fs_of(path).delete(self._Path(path), True)

    def _fs_of(self, path: str):
        return self._Path(path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def list_dirs(self, name: str) -> list[str]:
        path = self._Path(self.part_path(name))
        if not self._fs.exists(path):
            return []
        names = [st.getPath().getName() for st in self._fs.listStatus(path) if st.isDirectory()]
        # Spark's rule: hidden unless it is a partition folder (has "=").
        return sorted(n for n in names if not n.startswith(".") and (not n.startswith("_") or "=" in n))


def _already_done(entry: dict | None, batch: tuple[str, int] | None) -> bool:
    if entry is None or batch is None:
        return False
    last = entry.get("batches", {}).get(batch[0])
    return last is not None and batch[1] <= last


def _batches(entry: dict | None, batch: tuple[str, int] | None) -> dict:
    done = dict(entry.get("batches", {})) if entry else {}
    if batch is not None:
        done[batch[0]] = batch[1]
    return done


NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
WHOLE = "*"  # the single part of an unpartitioned table
PART = "__part"
#: A write into at most so many folders takes rows as its tasks hold them (so many files a task at most).
#: Into more, rows are first dealt by folder.
FEW_FOLDERS = 16
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: A merge takes about so many bytes of stored rows (current ones and batch) through the shuffle at a time, by key.
#: Every round reads them all, so there are no more than MOST_ROUNDS.
ROUND_BYTES, MOST_ROUNDS = 128 << 20, 8
_SAFE = re.compile(r"^[A-Za-z0-9_.\-]+$")


def _folder(value) -> str:
    if value is None:
        return f"{PART}={NULL_PARTITION}"
    text = str(value)
    if not _SAFE.match(text):
        raise ValueError(f"partition value {text!r} is not path-safe; use digits, letters, '.', '_' or '-'")
    return f"{PART}={text}"


def partition_column(expr: str | None) -> Column:
    return F.lit(None).cast("string") if expr is None else F.expr(expr).cast("string")


def _distinct_values(df: DataFrame) -> set:
    """Distinct values of a one-column frame of partition values: as many as
    the batch touches folders, whose names the driver writes to the log."""
    return {r[0] for r in df.distinct().collect()}


def touched_partitions(current: DataFrame | None, batch: DataFrame, keys: Sequence[str], expr: str) -> set[str]:
    """Partition folders holding batch rows or current rows of batch keys
    (a key may have moved). Only distinct partition values are collected."""
    part = partition_column(expr)
    values = _distinct_values(batch.select(part))
    if current is None:
        return {_folder(x) for x in values}
    bk = batch.select(*[F.col(f"`{k}`").alias(f"__bk{i}") for i, k in enumerate(keys)]).distinct()
    cond = key_match(current, bk, [(k, f"__bk{i}") for i, k in enumerate(keys)], True)
    values |= _distinct_values(current.join(bk, cond, "left_semi").select(part))
    return {_folder(x) for x in values}


class ReportTable:
    """A report table replaced by key (delete the batch keys, append the batch).

    With ``partition_expr`` (path-safe values, e.g. a month of the invoice
    date) an upsert rewrites only the partitions holding batch rows or
    target rows of batch keys; the others carry over by reference.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], partition_expr: str | None = None):
        self.spark, self.keys, self.log = spark, list(keys), TableLog(spark, root)
        self.partition_expr = partition_expr

    def read(self, partitions: set[str] | None = None, entry: dict | None = None) -> DataFrame | None:
        entry = entry or self.log.latest()
        if entry is None:
            return None
        schema = T.StructType.fromJson(entry["schema"])
        parts = [p for name, p in entry["current"].items() if partitions is None or name in partitions]
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self.log.part_path(p) for p in parts]).select(
            *[F.col(f"`{n}`") for n in schema.names])

    def upsert(self, batch: DataFrame, batch_id: tuple[str, int] | None = None, retries: int = 3) -> int | None:
        """Write the next version; returns it (None when the batch was done).
        Losing a commit race re-reads the latest version and tries again."""
        for attempt in range(retries):
            entry = self.log.latest()
            if _already_done(entry, batch_id):
                return None
            previous = entry["current"] if entry else {}
            if entry is None:
                touched, nxt = set(), batch
            else:
                if self.partition_expr is None:
                    touched = set(previous)
                else:
                    touched = touched_partitions(self.read(entry=entry), batch, self.keys, self.partition_expr)
                nxt = u.upsert(self.read(touched, entry), batch, self.keys)
            version = (entry["version"] + 1) if entry else 0
            current = {name: p for name, p in previous.items() if name not in touched}
            current.update(self._write(nxt, _stage("v", version)))
            try:
                self.log.commit({"version": version, "current": current, "schema": nxt.schema.jsonValue(),
                                 "batches": _batches(entry, batch_id)})
                return version
            except CommitConflict:
                if attempt == retries - 1:
                    raise
        return None

    def _write(self, df: DataFrame, stage: str) -> dict[str, str]:
        """Write ``df`` as the parts of ``stage``; returns folder -> path."""
        if self.partition_expr is None:
            df.write.mode("overwrite").option("compression", CODEC).parquet(self.log.part_path(stage))
            return {WHOLE: stage}
        # The rebalance hint lets AQE merge small partitions and split big
        # ones, so each folder gets files near the advisory size.
        (df.withColumn(PART, partition_column(self.partition_expr)).hint("rebalance", PART)
            .write.mode("overwrite").option("compression", CODEC).partitionBy(PART).parquet(self.log.part_path(stage)))
        return {name: f"{stage}/{name}" for name in self.log.list_dirs(stage)}

    def evolve(self, target: T.StructType) -> int:
        """Change the schema keeping old values (dropped or retyped columns
        live on as ``<c>_legacy``, see :mod:`ledgerlake.operators.evolve`).
        The table is rewritten once as a new version; the previous version
        stays readable as the back-up."""
        entry = self.log.latest()
        if entry is None:
            raise ValueError("no committed version to evolve")
        nxt = evolve(self.read(entry=entry), target)
        version = entry["version"] + 1
        self.log.commit({"version": version, "current": self._write(nxt, _stage("v", version)),
                         "schema": nxt.schema.jsonValue(), "batches": _batches(entry, None)})
        return version


class FactTable:
    """A versioned fact: append-only history, rewritten current rows.

    ``partition_expr`` (optional, SQL over payload columns, path-safe values,
    e.g. ``date_format(`invoice_date`, 'yyyyMM')``) splits the current rows
    into partitions. A delta load then rewrites only the partitions the batch
    touches - those of the batch rows and those holding current rows of the
    batch keys - and carries every other partition over by reference, so the
    cost of a load follows the batch, not the table. A full refresh rewrites
    all partitions (every key may close). Only the distinct partition values
    (one per month, say) reach the driver.
    """

    def __init__(self, spark: SparkSession, root: str, spec: v.VersionSpec, partition_expr: str | None = None,
                 full_scope: Sequence[str] = ()):
        self.spark, self.spec, self.log = spark, spec, TableLog(spark, root)
        self.partition_expr, self.full_scope = partition_expr, tuple(full_scope)

    def _read(self, parts: list[str], entry: dict, current: bool) -> DataFrame:
        """Rows of ``parts`` in the newest schema; the current flag is the folder they sit in.

        A part is read through the schema it was written with and reshaped at
        read time for every schema change since. Current rows from before a
        change get their hash over today's payload, so that the next load sees
        real changes only.
        """
        names = [f["name"] for f in entry["schema"]["fields"]]
        if not parts:
            return self.spark.createDataFrame([], T.StructType.fromJson(entry["schema"]))
        targets, out = entry.get("targets", []), None
        for level, some in _by_level(parts, entry).items():
            schema = T.StructType.fromJson(entry["schemas"][level])
            stored = T.StructType([f for f in schema.fields if f.name != v.CURRENT])
            df = self.spark.read.schema(stored).parquet(*[self.log.part_path(p) for p in some])
            df = df.withColumn(v.CURRENT, F.lit(current)).select(*[F.col(f"`{n}`") for n in schema.names])
            for target in targets[level:]:
                df = evolve(df, T.StructType.fromJson(target))
            if current and level < len(targets):
                df = df.withColumn(v.HASH, delta_hash(list(self.spec.payload)))
            df = df.select(*[F.col(f"`{n}`") for n in names])
            out = df if out is None else out.unionByName(df)
        return out

    def current(self, partitions: set[str] | None = None, entry: dict | None = None) -> DataFrame | None:
        """Current rows (of the given partition folders only, if given)."""
        entry = entry or self.log.latest()
        if entry is None:
            return None
        parts = [p for name, p in entry["current"].items() if partitions is None or name in partitions]
        return self._read(parts, entry, True)

    def read(self, entry: dict | None = None) -> DataFrame | None:
        """All versions (history and current rows)."""
        entry = entry or self.log.latest()
        if entry is None:
            return None
        return self._read(list(entry["history"]), entry, False).unionByName(self._read(list(entry["current"].values()), entry, True))

    def as_of(self, day) -> DataFrame | None:
        """Rows valid on ``day``. A history part holds rows that were opened on
        one day and closed on another, both in the log: only parts whose
        interval holds ``day`` are read, besides the current rows."""
        entry = self.log.latest()
        if entry is None:
            return None
        history = [p for p, (opened, closed) in entry["history"].items() if opened <= str(day) < closed]
        rows = self._read(history, entry, False).unionByName(self._read(list(entry["current"].values()), entry, True))
        return v.as_of(rows, day)

    def _partition(self) -> Column:
        return partition_column(self.partition_expr)

    def load(self, batch: DataFrame, stamp: v.LoadStamp, mode: str = "delta",
             batch_id: tuple[str, int] | None = None, order: Sequence[str] | None = None,
             retries: int = 3) -> int | None:
        """Merge ``batch`` and commit the next version.

        The batch is cast to the stored types, hashed and written once; then
        reduced to one row per key: the last by ``order``, or without an order
        the one that arrived last (arrival columns of a landing, else source
        file and values), equal ones by their place in the batch. The first
        load writes its batch as the table's parts, and once more only if a
        key is repeated. A merge shuffles rows in rounds by key, so that a part
        of them is on the disks at a time, and the written batch goes after the
        commit. Losing a commit race re-reads the latest version and merges again.

        An empty full batch (it would close the whole table) and a load date
        before the last committed one (validity ranges would overlap) are
        refused. ``full_scope`` columns limit what a full batch may close; they
        must follow from the key. If they hold the partition column, a key
        stays in its partition, and a load reads and rewrites the batch's
        partitions only, a full refresh too."""
        if mode == "full" and batch.isEmpty():
            raise ValueError("empty full batch: nothing landed for a full refresh")
        entry = self.log.latest()
        if _already_done(entry, batch_id):
            return None
        scratch = scratch_path(self.spark, "fact-batch")
        try:
            return self._load(batch, stamp, mode, batch_id, order, retries, scratch)
        finally:
            self.log.remove(scratch)

    def _load(self, batch: DataFrame, stamp: v.LoadStamp, mode: str, batch_id: tuple[str, int] | None,
              order: Sequence[str] | None, retries: int, scratch: str) -> int | None:
        staged = None
        for attempt in range(retries):
            entry = self.log.latest()
            if _already_done(entry, batch_id):
                return None
            previous = entry["current"] if entry else {}
            last = (entry or {}).get("load_date")
            if last and str(stamp.load_date) < last:
                raise ValueError(f"load date {stamp.load_date} is before the last committed one, {last}")
            version = (entry["version"] + 1) if entry else 0
            if entry is None:
                touched, (nxt, closed, written) = set(), self._write_first(batch, stamp, order)
            else:
                if staged is None:
                    staged = self._staged(batch, entry, order, scratch)
                folders, scope = None, self.full_scope
                if self.partition_expr is None:
                    touched, cur = set(previous), self.current(entry=entry)
                elif self.partition_expr.strip("`") in self.full_scope:
                    touched = touched_partitions(None, staged, self.spec.keys, self.partition_expr)
                    cur = self.current(touched, entry)
                    if len(scope) == 1 and cur.schema[scope[0]].dataType == T.StringType():
                        scope = ()  # the folders read are those of the batch's values: all their rows are in the scope
                elif mode == "full":
                    touched, cur = set(previous), self.current(entry=entry)
                    folders = touched | touched_partitions(None, staged, self.spec.keys, self.partition_expr)
                else:
                    touched = touched_partitions(self.current(entry=entry), staged, self.spec.keys, self.partition_expr)
                    cur = self.current(touched, entry)
                rounds = self._rounds(cur, staged, sum(self.log.size(self.log.part_path(p)) for name, p in previous.items() if name in touched) + self.log.size(scratch))
                merged = [v.merge_prepared(c, b, self.spec, stamp, mode, scope, staged) for c, b in rounds]
                nxt = merged[0]
                # closed rows: a folder for each day rows were opened on, so one for each version at most
                closed, written = self._write(merged, _stage("load", version), len(folders or touched) + version)
            current = {name: p for name, p in previous.items() if name not in touched}
            current.update(written)
            level = len(entry.get("targets", [])) if entry else 0
            try:
                self.log.commit({
                    "version": version,
                    "history": dict(entry["history"] if entry else {}, **{p: [opened, str(stamp.load_date)] for p, opened in closed.items()}),
                    "current": current,
                    "schema": nxt.schema.jsonValue(),
                    "schemas": (entry["schemas"][:level] if entry else []) + [nxt.schema.jsonValue()],
                    "targets": entry.get("targets", []) if entry else [],
                    "levels": dict(entry["levels"] if entry else {}, **{p: level for p in [*closed, *written.values()] if level}),
                    "load_date": str(stamp.load_date),
                    "batches": _batches(entry, batch_id),
                })
                return version
            except CommitConflict:
                if attempt == retries - 1:
                    raise
        return None

    def _rounds(self, cur: DataFrame, staged: DataFrame, size: int) -> list[tuple[DataFrame, DataFrame]]:
        """Current rows and batch in parts that share no key, by the bytes (``size``) of both."""
        n = max(1, min(MOST_ROUNDS, -(-size // ROUND_BYTES)))
        if n == 1:
            return [(cur, staged)]
        # As text: a number would be written into the generated code, and each round would compile its own.
        of = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.spec.keys]), F.lit(n)).cast("string")
        return [(cur.where(of == str(r)), staged.where(of == str(r))) for r in range(n)]

    def _staged(self, batch: DataFrame, entry: dict | None, order: Sequence[str] | None, path: str | None = None) -> DataFrame:
        """The batch, one row per key, cast and hashed: read from files that one job wrote."""
        prepared, marks = self._prepared(batch, entry, order)
        path = path or scratch_path(self.spark, "fact-batch")
        prepared.write.option("compression", CODEC).parquet(path)
        written = self.spark.read.schema(prepared.schema).parquet(path)
        repeated = self._repeated(written, marks)
        if repeated is not None:  # else every row is its key's last, and wide rows need not move
            written = v.keep_last(written, self.spec.keys, marks, repeated)
        return written.drop(*[m for m in marks if m.startswith("__")])

    def _prepared(self, batch: DataFrame, entry: dict | None, order: Sequence[str] | None) -> tuple[DataFrame, list[str]]:
        """The batch cast and hashed, and its columns that order rows of one key: those of ``order`` before the cast, the place in the batch."""
        if not order:
            order = [c for c in v.ARRIVAL if c in batch.columns] or (
                ([v.SOURCE_FILE] if v.SOURCE_FILE in batch.columns else []) + [c for c in self.spec.data_columns if c not in self.spec.keys])
        types = {f["name"]: T.StructField.fromJson(f).dataType.simpleString() for f in entry["schema"]["fields"]} if entry else None
        # Without a cast the prepared column is the batch's own.
        own = set() if types else {*self.spec.data_columns, v.SOURCE_FILE}
        marks = [*[c if c in own else f"__o{i}" for i, c in enumerate(order)], "__row"]
        copies = {f"__o{i}": F.col(f"`{c}`") for i, c in enumerate(order) if c not in own}
        kept = batch.withColumns(copies | {"__row": F.monotonically_increasing_id()})
        return v.prepare_batch(kept, self.spec, types, [*copies, "__row"]), marks

    def _repeated(self, written: DataFrame, marks: Sequence[str]) -> DataFrame | None:
        """The repeated keys of a written batch (:func:`versioning.repeated_keys`); None if there are none.

        Rows are counted by a short hash of the key first, and only those whose
        hash occurs again by the key itself."""
        near = F.xxhash64(*[F.col(f"`{k}`") for k in self.spec.keys])
        path = scratch_path(self.spark, "fact-repeated")

        def stored(df: DataFrame, name: str) -> DataFrame:
            with settings(df.sparkSession, {CLEANUP: "true"}):
                df.write.parquet(f"{path}-{name}")
            return self.spark.read.schema(df.schema).parquet(f"{path}-{name}")

        met = stored(written.groupBy(near.alias("__near")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__near"), "near")
        if met.isEmpty():
            return None
        some = written.join(met, near == met["__near"], "left_semi")
        repeated = stored(v.repeated_keys(some, self.spec.keys, marks), "keys")
        return None if repeated.isEmpty() else repeated

    def _write_first(self, batch: DataFrame, stamp: v.LoadStamp, order: Sequence[str] | None) -> tuple[DataFrame, dict[str, str], dict[str, str]]:
        """Version 1 of every key, written as parts of the table with the columns
        that order rows of one key beside (no reader asks for those)."""
        prepared, marks = self._prepared(batch, None, order)
        opened = v.opened_rows(prepared, self.spec, stamp)
        own = [m for m in marks if m not in opened.columns]
        rows = v.opened_rows(prepared, self.spec, stamp, own)
        folders = 1 if self.partition_expr is None else prepared.select(self._partition()).distinct().limit(FEW_FOLDERS + 1).count()
        stage = _stage("load", 0)
        parts = self._write([rows], stage, folders)
        written = self.spark.read.schema(rows.schema).parquet(self.log.part_path(stage)).select(*[F.col(f"`{c}`") for c in rows.columns])
        repeated = self._repeated(written, marks)
        if repeated is not None:
            parts = self._write([v.keep_last(written, self.spec.keys, marks, repeated).drop(*own)], _stage("load", 0), folders)
            self.log.remove(self.log.part_path(stage))
        return opened, *parts

    def _write(self, rounds: Sequence[DataFrame], stage: str, folders: int) -> tuple[dict[str, str], dict[str, str]]:
        """One job a round writes a version's rows into about so many ``folders``:
        current rows in their partition folders, closed rows in one folder for
        each day they were opened on (at most as many as loads before). Returns
        closed part -> that day and current folder -> part."""
        part = F.when(F.col(v.CURRENT), self._partition()).otherwise(F.col(v.VALID_FROM).cast("string"))
        few = folders <= FEW_FOLDERS
        # Into few folders: a file open for each, so wide rows need no sort by folder.
        wanted = {CLEANUP: "true"} | ({WRITERS: str(FEW_FOLDERS)} if few else {})
        for df in rounds:
            df = df.withColumn(PART, part)
            if not few:
                # The rebalance hint lets AQE merge small partitions and split big
                # ones, so each folder gets files near the advisory size.
                df = df.hint("rebalance", v.CURRENT, PART)
            with settings(df.sparkSession, wanted):
                df.write.mode("append").option("compression", CODEC).partitionBy(v.CURRENT, PART).parquet(self.log.part_path(stage))
        closed, current = f"{stage}/{v.CURRENT}=false", f"{stage}/{v.CURRENT}=true"
        return ({f"{closed}/{name}": name.removeprefix(f"{PART}=") for name in self.log.list_dirs(closed)},
                {(WHOLE if self.partition_expr is None else name): f"{current}/{name}" for name in self.log.list_dirs(current)})

    def evolve(self, target: T.StructType, spec: v.VersionSpec) -> int:
        """Change the schema keeping old values (dropped or retyped columns
        live on as ``<c>_legacy``, carried into later versions) and switch to
        ``spec``. Only the log is written: stored parts keep the schema they
        were written with and are reshaped when they are read, until a load
        rewrites their partition. The previous version stays as the back-up."""
        entry = self.log.latest()
        if entry is None:
            raise ValueError("no committed version to evolve")
        self.spec = spec
        schema = evolve(self.spark.createDataFrame([], T.StructType.fromJson(entry["schema"])), target).schema.jsonValue()
        version = entry["version"] + 1
        self.log.commit(entry | {"version": version, "schema": schema, "schemas": entry["schemas"] + [schema],
                                 "targets": entry.get("targets", []) + [target.jsonValue()]})
        return version


def _by_level(parts: list[str], entry: dict) -> dict[int, list[str]]:
    """Parts by the number of schema changes that came before they were written."""
    found: dict[int, list[str]] = {}
    for p in parts:
        found.setdefault(entry.get("levels", {}).get(p, 0), []).append(p)
    return dict(sorted(found.items()))


def publish_current_view(table: FactTable, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The reporting view over an external catalog table of the stored files.

    The external table is partitioned by the current flag and the stored part;
    its partitions point at the folders of the newest version, so nothing is
    copied. The view fixes the column order and filters on the flag, which the
    catalog answers by pruning partitions: readers never list or open the
    history.
    """
    entry = table.log.latest()
    if entry is None:
        raise ValueError(f"table at {table.log.root} has no committed version")
    if len(_by_level([*entry["current"].values()], entry)) > 1:
        raise ValueError("parts from before a schema change: load or rewrite their partitions first")
    spark = table.spark
    fields = T.StructType.fromJson(entry["schema"]).fields
    stored = f"{name}_stored"
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    spark.sql(f"DROP TABLE IF EXISTS {stored}")  # external: the files stay
    flag = next(f for f in fields if f.name == v.CURRENT)
    columns_sql = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*(f for f in fields if f.name != v.CURRENT), flag])
    spark.sql(f"CREATE TABLE {stored} ({columns_sql}, {PART} string) USING parquet PARTITIONED BY (`{v.CURRENT}`, {PART}) LOCATION '{table.log.root}'")
    parts = [(True, p) for p in entry["current"].values()] + [(False, p) for p in entry["history"]]
    if parts:
        spark.sql(f"ALTER TABLE {stored} ADD " + " ".join(
            f"PARTITION (`{v.CURRENT}`={str(flag).lower()}, {PART}='{i:05d}') LOCATION '{table.log.part_path(p)}'" for i, (flag, p) in enumerate(parts)))
    names = list(columns or [f.name for f in fields])
    spark.sql(f"CREATE VIEW {name} AS SELECT {', '.join(f'`{c}`' for c in names)} FROM {stored} WHERE `{v.CURRENT}` = true")
    return spark.table(name)
