"""Look-up joins with the semantics of a pandas ``merge``.

* keys are matched null-safely (a null key meets a null key),
* one merged key column is returned (left value, else right value),
* other columns present on both sides get the suffixes ``_x`` / ``_y``,
* repeated look-up keys multiply rows; nothing is de-duplicated.

Scale notes. A look-up key can be very hot (one role may hold a third of
all line items), so no join here shuffles the big side *by the look-up key*
unless AQE can split it:

* ``left``: a broadcast hash join when the look-up is known to be small
  (``bounded=True``, checked by the caller), else a sort-merge left outer
  join whose skewed partitions AQE splits.
* ``full``: Spark cannot split skewed partitions of a full outer join, so it
  is rewritten as *left join* ∪ *look-up rows whose key the big side never
  has*. The second half only needs the distinct keys of the big side, which
  are pre-aggregated map-side before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def key_match(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], null_safe: bool) -> Column:
    conds = [
        left[lk].eqNullSafe(right[rk]) if null_safe else left[lk] == right[rk]
        for lk, rk in pairs
    ]
    return reduce(lambda a, b: a & b, conds)


def one_null_row(lookup: DataFrame, key: str) -> DataFrame:
    """``lookup`` with one row of a null key: the smallest by its other columns.

    The rule for look-ups whose key is missing in many rows. Matched null-safely,
    every such row would meet every row without a key (their numbers multiply);
    one stands for "no key" instead. The null rows are added up before they
    meet, so their number does not matter.
    """
    others = [c for c in lookup.columns if c != key]
    empty = lookup.where(_c(key).isNull()).agg(F.min(F.struct(*[_c(c) for c in others])).alias("__row"), F.count(F.lit(1)).alias("__n")).where("__n > 0")
    kind = lookup.schema[key].dataType
    stand = empty.select(*[F.lit(None).cast(kind).alias(c) if c == key else F.col("__row")[c].alias(c) for c in lookup.columns])
    return lookup.where(_c(key).isNotNull()).unionByName(stand)


def merge(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    null_safe: bool = True,
    bounded: bool = False,
    suffixes: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """pandas-style merge of ``left`` and ``right`` on the columns ``on``.

    ``how`` is one of ``left``, ``inner``, ``full`` (pandas "outer").
    ``bounded`` says the caller has checked that ``right`` is small enough to
    broadcast.
    """
    on = list(on)
    clash = [c for c in right.columns if c in left.columns and c not in on]
    lname = {c: (c + suffixes[0] if c in clash else c) for c in left.columns}
    rname = {c: (c + suffixes[1] if c in clash else c) for c in right.columns if c not in on}
    rkey = {k: f"__rk{i}" for i, k in enumerate(on)}

    lside = left.select(*[_c(c).alias(lname[c]) for c in left.columns])
    rside = right.select(*[_c(k).alias(rkey[k]) for k in on], *[_c(c).alias(rname[c]) for c in rname])
    out_cols = [lname[c] for c in left.columns] + list(rname.values())

    if how in ("left", "inner"):
        rjoin = F.broadcast(rside) if bounded else rside
        joined = lside.join(rjoin, key_match(lside, rjoin, [(k, rkey[k]) for k in on], null_safe), how)
        return joined.select(*[_c(c) for c in out_cols])

    if how != "full":
        raise ValueError(f"unsupported join type {how!r}; use left, inner or full")

    matched = merge(left, right, on, "left", null_safe=null_safe, bounded=bounded, suffixes=suffixes)
    left_keys = lside.select(*[_c(k) for k in on]).distinct()
    orphans = rside.join(
        left_keys, key_match(rside, left_keys, [(rkey[k], k) for k in on], null_safe), "left_anti"
    )
    orphans = orphans.select(
        *[
            (_c(rkey[c]).alias(c) if c in on else F.lit(None).cast(left.schema[c].dataType).alias(lname[c]))
            for c in left.columns
        ],
        *[_c(c) for c in rname.values()],
    )
    return matched.unionByName(orphans)
