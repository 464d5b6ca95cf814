"""Versioned fact tables (type-2 history).

Every change of a business row becomes a new version; the table keeps one
current row per key. Bookkeeping columns (names as in the warehouse table):

    mio_delete_ind          'Y' when the key vanished in a full refresh
    mio_current_status      true on the current version only
    mio_version_number      1, 2, ... per key
    mio_created_by/_date_time   run that opened version 1 (carried forward)
    mio_updated_by/_date_time   run that wrote this version
    mio_source_filename     file the payload came from
    mio_delta_hash          SHA-256 over the payload (change detection)
    mio_version_valid_from/_to  validity, day precision, ``to`` exclusive

Design for scale: a load touches only *current* rows. One full outer join of
the current rows and the batch finds unchanged, changed, vanished and unseen
keys at once, and one ``inline`` over an array of output rows per joined row
emits them, so current rows are scanned once and the batch is cast and hashed
once. Keys are unique on both sides (one current row per key; the batch
reduced by :func:`last_rows`), so no key can be hot. The rows that a load
joins are those it has to rewrite anyway.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.hashing import delta_hash, ident, row_id, sql_text
from ledgerlake.operators.joins import key_match
from ledgerlake.operators.sequence import sequence_by_key
from ledgerlake.schemas import DELETE_MARK

DELETE = "mio_delete_ind"
CURRENT = "mio_current_status"
VERSION = "mio_version_number"
CREATED_BY = "mio_created_by"
CREATED_AT = "mio_create_date_time"
UPDATED_BY = "mio_updated_by"
UPDATED_AT = "mio_update_date_time"
SOURCE_FILE = "mio_source_filename"
HASH = "mio_delta_hash"
VALID_FROM = "mio_version_valid_from"
VALID_TO = "mio_version_valid_to"

BOOKKEEPING = [
    (DELETE, T.StringType()),
    (CURRENT, T.BooleanType()),
    (VERSION, T.IntegerType()),
    (CREATED_BY, T.StringType()),
    (CREATED_AT, T.TimestampNTZType()),
    (UPDATED_BY, T.StringType()),
    (UPDATED_AT, T.TimestampNTZType()),
    (SOURCE_FILE, T.StringType()),
    (HASH, T.StringType()),
    (VALID_FROM, T.DateType()),
    (VALID_TO, T.DateType()),
]
BOOK_NAMES = [n for n, _ in BOOKKEEPING]

#: Columns that a landing adds: when the row's file arrived, its path, the block of the file.
#: Rows of one block keep their order by the place in the batch.
ARRIVAL = ["__landed_at", "__landed_path", "__landed_block"]


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


@dataclass(frozen=True)
class VersionSpec:
    """Shape of a versioned table.

    ``keys`` match batch rows to stored rows; ``payload`` is hashed for change
    detection; ``carry`` columns come with the batch row but are not hashed
    (parent ids); ``id_column`` is the row id (computed from the record type
    and keys unless the batch brings it); ``layout`` fixes the stored column
    order (default: id, data columns, bookkeeping).
    """

    keys: tuple[str, ...]
    payload: tuple[str, ...]
    record_type: str = "ROW"
    id_column: str | None = "fact_guid"
    carry: tuple[str, ...] = ()
    layout: tuple[str, ...] | None = None

    def __post_init__(self):
        if self.layout is not None:
            needed = set(([self.id_column] if self.id_column else []) + self.data_columns + BOOK_NAMES)
            missing = needed - set(self.layout)
            if missing:
                raise ValueError(f"layout lacks columns {sorted(missing)}")

    @property
    def data_columns(self) -> list[str]:
        """Columns taken from the batch: keys (unless hashed or the id), payload, carry."""
        extra = [k for k in self.keys if k not in self.payload and k not in self.carry and k != self.id_column]
        return extra + list(self.payload) + list(self.carry)

    @property
    def columns(self) -> list[str]:
        if self.layout is not None:
            return list(self.layout)
        return ([self.id_column] if self.id_column else []) + self.data_columns + BOOK_NAMES


@dataclass(frozen=True)
class LoadStamp:
    """Who and when: the load date opens/closes versions, the run tags audit."""

    load_date: str | dt.date
    run_by: str
    run_ts: str | dt.datetime

    def date(self) -> Column:
        return F.lit(str(self.load_date)).cast("date")

    def by(self) -> Column:
        return F.lit(self.run_by)

    def ts(self) -> Column:
        return F.lit(self.ts_text()).cast("timestamp_ntz")

    def ts_text(self) -> str:
        return self.run_ts.isoformat(sep=" ") if isinstance(self.run_ts, dt.datetime) else str(self.run_ts)

    def sql(self) -> tuple[str, str, str]:
        """(load date, run by, run time) as SQL literals."""
        return f"DATE'{self.load_date}'", sql_text(self.run_by), f"TIMESTAMP_NTZ'{self.ts_text()}'"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order`` (ties: any one of them).

    One pass over ``df``, whole rows through the aggregate; see
    :func:`last_rows` for wide rows that can be read twice.
    """
    others = [c for c in df.columns if c not in keys]
    picked = F.max_by(F.struct(*[_c(c) for c in others]), F.struct(*[_c(o) for o in order]))
    return (
        df.groupBy(*[_c(k) for k in keys])
        .agg(picked.alias("__row"))
        .select(*[_c(k) for k in keys], *[F.col("__row")[c].alias(c) for c in others])
        .select(*[_c(c) for c in df.columns])
    )


def last_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``, which must be unique within a key.

    Late materialisation: only keys and order columns go through the
    aggregate; rows of keys that occur once are passed through, rows of the
    others are kept if they are their key's last. ``df`` is read twice (a
    written batch), the second time joined with the repeated keys alone, so a
    key with a third of all rows meets one row, and AQE splits or broadcasts
    that join.
    """
    return keep_last(df, keys, order, repeated_keys(df, keys, order))


def repeated_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keys of several rows (``__r0``, ...) and the order values of their last row."""
    return df.groupBy(*[_c(k).alias(f"__r{i}") for i, k in enumerate(keys)]).agg(
        F.max(F.struct(*[_c(o) for o in order])).alias("__last"), F.count(F.lit(1)).alias("__n")).where("__n > 1")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], repeated: DataFrame) -> DataFrame:
    last = F.struct(*[_c(o) for o in order])
    met = df.join(repeated, key_match(df, repeated, [(k, f"__r{i}") for i, k in enumerate(keys)], True), "left")
    return met.where(F.col("__n").isNull() | last.eqNullSafe(F.col("__last"))).select(*[_c(c) for c in df.columns])


def prepare_batch(batch: DataFrame, spec: VersionSpec, types: dict[str, str] | None = None, also: Sequence[str] = ()) -> DataFrame:
    """Data columns, source file (if any), change hash, row id and the columns named by ``also``.

    ``types``: the stored types (name to type). Values are cast to them before
    the hash, so a batch that spells a number otherwise (1.500 for 1.50) opens
    no new version; a value that does not fit is an error.
    """
    types = types or {}
    src = _c(SOURCE_FILE) if SOURCE_FILE in batch.columns else F.lit(None).cast("string")
    cast = [(_c(c).cast(types[c]) if c in types else _c(c)).alias(c) for c in spec.data_columns]
    if spec.id_column and spec.id_column in batch.columns and spec.id_column not in spec.data_columns:
        cast.append(_c(spec.id_column))
    cols = [_c(c) for c in spec.data_columns] + [_c(SOURCE_FILE), delta_hash(list(spec.payload)).alias(HASH)]
    if spec.id_column:
        rid = _c(spec.id_column) if spec.id_column in batch.columns else row_id(spec.record_type, list(spec.keys))
        cols.append(rid.alias(spec.id_column))
    return batch.select(*cast, src.alias(SOURCE_FILE), *also).select(*cols, *also)


def empty_table(spark: SparkSession, batch: DataFrame, spec: VersionSpec) -> DataFrame:
    """An empty versioned table shaped for ``batch``.

    Built as a projection of the batch under ``WHERE false``: Catalyst folds
    it into an empty relation and prunes every join against it, so a first
    load is planned as a plain projection of the batch.
    """
    cols = {c: _c(c) for c in spec.data_columns}
    if spec.id_column:
        cols[spec.id_column] = F.lit(None).cast("string").alias(spec.id_column)
    cols.update({n: F.lit(None).cast(t.simpleString()).alias(n) for n, t in BOOKKEEPING})
    return batch.select(*[cols[c] for c in spec.columns]).where(F.lit(False))


def stored_types(fact: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in fact.schema.fields}


def versioned_merge(fact: DataFrame, batch: DataFrame, spec: VersionSpec, stamp: LoadStamp,
                    mode: str = "delta", scope: Sequence[str] = ()) -> DataFrame:
    """Next state of a versioned table after loading ``batch``.

    ``batch`` has one row per key (reduce it with :func:`last_rows`).
    delta mode: new keys open version 1, changed keys close the current
    version and open the next, unchanged and absent keys stay as they are.
    full mode: additionally every current key absent from the batch is closed
    and reopened as a new version marked deleted; a marked key that returns
    counts as changed. Loading the same batch again changes nothing. With
    ``scope`` (e.g. the record type) a full batch speaks only for the scope
    values it holds: keys of other values stay open.
    Stored columns the spec does not name (``*_legacy`` columns after a
    schema change) are carried from the current version; new keys get null.
    """
    return merge_prepared(fact, prepare_batch(batch, spec, stored_types(fact)), spec, stamp, mode, scope)


def _opened(columns: Sequence[str], spec: VersionSpec, stamp: LoadStamp, prefix: str = "") -> dict[str, str]:
    """SQL of each of ``columns`` in version 1 of a prepared row, whose columns have the ``prefix``."""
    day, by, ts = stamp.sql()
    opened = {c: "NULL" for c in columns}
    opened.update({c: ident(prefix + c) for c in spec.data_columns + [SOURCE_FILE, HASH]})
    if spec.id_column:
        opened[spec.id_column] = ident(prefix + spec.id_column)
    opened.update({
        DELETE: "NULL", CURRENT: "true", VERSION: "1", CREATED_BY: by, CREATED_AT: ts,
        UPDATED_BY: by, UPDATED_AT: ts, VALID_FROM: day, VALID_TO: "NULL",
    })
    return opened


def opened_rows(b: DataFrame, spec: VersionSpec, stamp: LoadStamp, also: Sequence[str] = ()) -> DataFrame:
    """Version 1 of every row of a prepared batch; columns named by ``also`` are kept."""
    types, opened = stored_types(empty_table(b.sparkSession, b, spec)), _opened(spec.columns, spec, stamp)
    return b.selectExpr(*[f"CAST({opened[c]} AS {types[c]}) AS {ident(c)}" for c in spec.columns], *[ident(c) for c in also])


#: Digits of a hash or a row id that is one.
_HEX = "'^([0-9a-f][0-9a-f])+$'"


def packed(name: str) -> str:
    """SQL of a text as bytes, half as many for hexadecimal digits; :func:`unpacked` gives the text back."""
    c = ident(name)
    return f"CASE WHEN {c} RLIKE {_HEX} THEN concat(X'01', unhex({c})) ELSE concat(X'00', CAST({c} AS BINARY)) END"


def unpacked(name: str) -> str:
    c = ident(name)
    rest = f"substring({c}, 2)"
    return f"CASE WHEN substring({c}, 1, 1) = X'01' THEN lower(hex({rest})) ELSE CAST({rest} AS STRING) END"


def merge_prepared(fact: DataFrame, b: DataFrame, spec: VersionSpec, stamp: LoadStamp,
                   mode: str = "delta", scope: Sequence[str] = (), spoken: DataFrame | None = None) -> DataFrame:
    """:func:`versioned_merge` for a batch that :func:`prepare_batch` made.

    ``spoken``: the whole batch, whose scope values count, if ``fact`` and ``b``
    hold some of the keys only.
    """
    if mode not in ("delta", "full"):
        raise ValueError(f"unknown load mode {mode!r}; expected 'delta' or 'full'")
    keys = list(spec.keys)
    types = stored_types(fact)
    out_cols = spec.columns + [c for c in fact.columns if c not in spec.columns]

    cur = fact.filter(_c(CURRENT) == F.lit(True))
    hist = fact.filter(~F.coalesce(_c(CURRENT), F.lit(False)))

    # Row ids and hashes are most of a row: they go through the join as bytes.
    short = [c for c in dict.fromkeys([HASH, *([spec.id_column] if spec.id_column else []), *spec.carry]) if types[c] == "string" and c not in scope]
    cur = cur.withColumns({c: F.expr(packed(c)) for c in short})
    nb = b.withColumns({c: F.expr(packed(c)) for c in short if c in b.columns})
    nb = nb.select(
        *[_c(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        *[_c(c).alias(f"__n_{c}") for c in b.columns],
        F.lit(True).alias("__in_batch"),
    )
    cond = key_match(cur, nb, [(k, f"__k{i}") for i, k in enumerate(keys)], True)

    # The per-row output is one SQL expression (parsed once on the JVM): an
    # array of the rows a joined row turns into.
    day, by, ts = stamp.sql()
    in_batch = "(`__in_batch` IS NOT NULL)"
    marked = f"coalesce({ident(DELETE)} = '{DELETE_MARK}', false)"
    changed = f"({in_batch} AND ({ident(HASH)} <> {ident('__n_' + HASH)} OR {marked}))"
    spoken_for = "`__in_scope` IS NOT NULL" if scope else "true"
    vanished = f"(NOT {in_batch} AND NOT {marked} AND {spoken_for})" if mode == "full" else "false"
    if mode == "full" and scope:
        values = (b if spoken is None else spoken).select(*[_c(c).alias(f"__s{i}") for i, c in enumerate(scope)]).distinct().withColumn("__in_scope", F.lit(True))
        cur = cur.join(values, key_match(cur, values, [(c, f"__s{i}") for i, c in enumerate(scope)], True), "left")
    closing = f"({changed} OR {vanished})"

    def row(values: dict[str, str]) -> str:
        return "named_struct(" + ", ".join(
            f"{sql_text(c)}, CAST({values[c]} AS {types[c]})" for c in out_cols) + ")"

    kept = {c: ident(c) for c in out_cols}
    closed = dict(kept)
    closed.update({CURRENT: "false", VALID_TO: day, UPDATED_BY: by, UPDATED_AT: ts})
    reopened = dict(kept)
    reopened.update({c: f"CASE WHEN {changed} THEN {ident('__n_' + c)} ELSE {ident(c)} END"
                     for c in spec.data_columns + [SOURCE_FILE, HASH]})
    if spec.id_column:
        reopened[spec.id_column] = ident(spec.id_column)
    reopened.update({
        DELETE: f"CASE WHEN {changed} THEN NULL ELSE '{DELETE_MARK}' END",
        CURRENT: "true",
        VERSION: f"{ident(VERSION)} + 1",
        CREATED_BY: ident(CREATED_BY),
        CREATED_AT: ident(CREATED_AT),
        UPDATED_BY: by,
        UPDATED_AT: ts,
        VALID_FROM: day,
        VALID_TO: "NULL",
    })
    opened = _opened(out_cols, spec, stamp, "__n_")
    from_current = f"CASE WHEN {closing} THEN array({row(closed)}, {row(reopened)}) ELSE array({row(kept)}) END"

    # One full outer join (unique keys on both sides, so no hot key) shuffles
    # each side once and yields every output row, unseen keys included.
    j = cur.join(nb, cond, "full")
    j = j.withColumns({c: F.expr(unpacked(c)) for s in short for c in (s, f"__n_{s}") if c in j.columns})
    rows = f"CASE WHEN {ident(CURRENT)} IS NULL THEN array({row(opened)}) ELSE {from_current} END"
    return hist.select(*out_cols).unionByName(j.select(F.inline(F.expr(rows))))


def initial_load(spark: SparkSession, batch: DataFrame, spec: VersionSpec, stamp: LoadStamp) -> DataFrame:
    """First load into an empty table: every key opens version 1."""
    return versioned_merge(empty_table(spark, batch, spec), batch, spec, stamp)


def classify_changes(fact: DataFrame, batch: DataFrame, spec: VersionSpec) -> DataFrame:
    """Per key: ``new``, ``changed``, ``unchanged`` or ``missing``.

    A full outer join of current rows and the (one row per key) batch; both
    sides have unique keys, so the join cannot be skewed by a hot key.
    """
    keys = list(spec.keys)
    cur = fact.filter(_c(CURRENT) == F.lit(True)).select(
        *[_c(k).alias(f"__c{i}") for i, k in enumerate(keys)],
        _c(HASH).alias("__ch"), _c(DELETE).alias("__cdel"),
    )
    b = prepare_batch(batch, spec, stored_types(fact)).select(
        *[_c(k).alias(f"__b{i}") for i, k in enumerate(keys)], _c(HASH).alias("__bh"), F.lit(True).alias("__in")
    )
    j = cur.join(b, key_match(cur, b, [(f"__c{i}", f"__b{i}") for i in range(len(keys))], True), "full")
    in_cur = F.col("__ch").isNotNull()
    in_batch = F.col("__in").isNotNull()
    marked = F.coalesce(F.col("__cdel") == F.lit(DELETE_MARK), F.lit(False))
    change = (
        F.when(~in_cur, "new")
        .when(~in_batch, "missing")
        .when((F.col("__ch") != F.col("__bh")) | marked, "changed")
        .otherwise("unchanged")
    )
    return j.select(
        *[F.when(in_cur, F.col(f"__c{i}")).otherwise(F.col(f"__b{i}")).alias(k) for i, k in enumerate(keys)],
        change.alias("change"),
    )


def current_rows(fact: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Current versions only (a null flag is not current), fixed column order."""
    out = fact.filter(_c(CURRENT) == F.lit(True))
    return out.select(*[_c(c) for c in (columns or fact.columns)])


def as_of(fact: DataFrame, day: str | dt.date) -> DataFrame:
    """The version of each key valid on ``day`` (valid_from <= day < valid_to)."""
    d = F.lit(str(day)).cast("date")
    return fact.filter((_c(VALID_FROM) <= d) & (_c(VALID_TO).isNull() | (d < _c(VALID_TO))))


def version_chain(log: DataFrame, keys: Sequence[str], ts: str, tiebreak: str) -> DataFrame:
    """Versions from a change log: one row per change, numbered per key by
    (ts, tiebreak); a version is valid from its ts until the next change's ts.

    Uses :func:`ledgerlake.operators.sequence.sequence_by_key`, so a key with
    a large share of all changes is spread over many tasks.
    """
    seq = sequence_by_key(log, keys, [ts, tiebreak], carry=[ts], seq_col="__seq", next_prefix="__next_")
    return seq.select(
        *[_c(c) for c in log.columns],
        F.col("__seq").cast("int").alias("version_number"),
        _c(ts).alias("valid_from"),
        F.col(f"`__next_{ts}`").alias("valid_to"),
        F.col(f"`__next_{ts}`").isNull().alias("is_current"),
    )
