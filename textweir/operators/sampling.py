"""Reproducible heads, samples and splits as plain filters.

A sample is "the n rows with the smallest keys". Ranking all rows in one window would put
a class, or the whole table, on one task. Instead the n-th smallest key is bracketed by a
mergeable quantile sketch of fixed size, and one exact pass counts what lies below the bracket
and looks at the few keys inside. The sample is every row up to that key: a filter without
shuffle, join or window.

Rows with equal keys are told apart by a hash of all their columns, which only such rows need;
rows that are equal in every column stay together, on one side of a bound.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Quantiles that a pass asks for, and the sketch's accuracy: a rank is off by a ten-thousandth.
_GRID = 256
_ACCURACY = 10_000
# Keys that the exact pass may look at one by one; a wider bracket is narrowed again.
_LISTED = 200_000
_TURN = -(1 << 63)
_CUT = 11


@dataclass(frozen=True)
class Bound:
    """The last wanted key; ``among`` of the rows that have it are wanted, all if null."""

    at: int
    among: int | None


def _md5_ordinal(key: str, seed: int) -> Column:
    """Reproducible pseudo-random number: the first 60 bits of the md5 of ``<key>-<seed>``.

    They order as the md5 itself does.
    """
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def _row_ordinal(df: DataFrame) -> Column:
    """A hash of the whole row as a number that orders as its unsigned form."""
    return F.xxhash64(*df.columns).bitwiseXOR(F.lit(_TURN))


def _any(conditions) -> Column:
    return functools.reduce(operator.or_, conditions, F.lit(False))


def key_bounds(
    df: DataFrame, ordinal: Column, wanted: Callable[[object, int], int], group: Column | None = None
) -> dict[object, Bound]:
    """The ``wanted(g, n)``-th smallest ``ordinal`` of each group ``g`` of ``n`` rows.

    A group with no more rows than wanted, or none wanted, gets no entry. Null ordinals are left
    out; a null group is a group. Groups are few: classes, or one. Two passes settle about 15
    million rows of a group, and each further one narrows the bracket 80 times.
    """
    keyed = df.select((F.lit(0) if group is None else group).alias("g"), ordinal.alias("o"))
    keyed = keyed.where(F.col("o").isNotNull())
    grid = [n / _GRID for n in range(_GRID + 1)]
    found: dict[object, Bound] = {}
    active: dict[object, tuple[int, int, int]] | None = None
    while active is None or active:
        some = keyed if active is None else keyed.where(
            _any(F.col("g").eqNullSafe(F.lit(g)) & F.col("o").between(lo, hi) for g, (lo, hi, _) in active.items())
        )
        # The sketch works in doubles: it gets differences below 2**53, else numbers cut to 53 bits.
        close = active is not None and all(hi - lo < 1 << 53 for lo, hi, _ in active.values())
        cut = 0 if close else _CUT
        base = F.lit(0).cast("bigint")
        for g, (lo, _, _) in active.items() if close else ():
            base = F.when(F.col("g").eqNullSafe(F.lit(g)), F.lit(lo)).otherwise(base)
        short = F.col("o") - base if close else F.shiftright("o", _CUT)
        sketch = F.percentile_approx(short, grid, _ACCURACY).alias("q")
        spans, most = {}, 0
        for r in some.groupBy("g").agg(F.count("o").alias("n"), sketch).collect():
            rank = wanted(r["g"], r["n"]) if active is None else active[r["g"]][2]
            if active is None and not 0 < rank < r["n"]:
                continue
            step = rank * _GRID / r["n"]
            least = active[r["g"]][0] if close else 0
            lo = least + (r["q"][max(0, math.floor(step) - 1)] << cut)
            hi = least + (r["q"][min(_GRID, math.ceil(step) + 1)] + 1 << cut) - 1
            spans[r["g"]] = (lo, hi, rank)
            most = max(most, r["n"] * (3 / _GRID + 2 / _ACCURACY))
        mine = {g: F.col("g").eqNullSafe(F.lit(g)) for g in spans}
        inside = some.where(_any(mine[g] & (F.col("o") <= hi) for g, (_, hi, _) in spans.items()))
        below = _any(mine[g] & (F.col("o") < lo) for g, (lo, _, _) in spans.items())
        listed = most <= _LISTED
        # The ends of the bracket are cells of the sketch: single keys, or keys cut alike.
        end = (1 << cut) - 1
        low = _any(mine[g] & (F.col("o") <= lo + end) for g, (lo, _, _) in spans.items())
        high = _any(mine[g] & (F.col("o") >= hi - end) for g, (_, hi, _) in spans.items())
        part = F.when(low, 0).when(high, 2).otherwise(1).cast("bigint")
        shown = F.when(~below, F.col("o") if listed else part)
        counts: dict[object, dict] = {g: {} for g in spans}
        for r in inside.groupBy("g", shown.alias("o")).count().collect() if spans else ():
            counts[r["g"]][r["o"]] = r["count"]
        active = {}
        for g, (lo, hi, rank) in spans.items():
            held = counts[g]
            rank -= held.pop(None, 0)
            for at in sorted(held):
                if rank <= held[at]:
                    break
                rank -= held[at]
            within = (lo, lo + end) if at == 0 else (hi - end, hi) if at == 2 else (lo + end + 1, hi - end - 1)
            if listed or within[0] == within[1]:
                found[g] = Bound(at if listed else within[0], rank if rank < held[at] else None)
            else:
                # What repeats at the ends is out of the way, so every bracket is narrower.
                active[g] = (*within, rank)
    return found


def _up_to(df: DataFrame, ordinal: Column, bound: Bound) -> Column:
    """True for the rows up to a bound; ties are settled by a hash of the row."""
    if bound.among is None:
        return ordinal <= bound.at
    tie = _row_ordinal(df)
    last = key_bounds(df.where(ordinal == bound.at), tie, lambda *_: bound.among)
    equal = tie <= last[0].at if last else F.lit(True)
    return F.when(ordinal < bound.at, True).when(ordinal == bound.at, equal).otherwise(False)


def head(df: DataFrame, n: int, key: str) -> DataFrame:
    """The first ``n`` rows by a unique integer key.

    Rows without a key come last, in the order of a hash of the row.
    """
    bounds = key_bounds(df, F.col(key).cast("bigint"), lambda *_: n)
    if bounds:
        return df.where(F.col(key) <= bounds[0].at)
    keyed = F.col(key).isNotNull()
    rest = n - df.where(keyed).count()
    if rest <= 0:
        return df.where(keyed)
    tie = F.shiftrightunsigned(F.xxhash64(*df.columns), 2)
    last = key_bounds(df.where(~keyed), tie, lambda *_: rest)
    return df.where(keyed | (tie <= last[0].at)) if last else df


def head_per_class(df: DataFrame, quotas: dict[int, int], key: str, label: str = "label"):
    """The first ``quotas[c]`` rows of each class by a unique integer key."""
    asked = df.where(F.col(label).isin(list(quotas)))
    bounds = key_bounds(asked, F.col(key).cast("bigint"), lambda c, _: quotas[c], F.col(label))
    keep = F.lit(False)
    for value, quota in quotas.items():
        if quota <= 0:
            continue
        mine = F.col(label) == value
        keep = keep | (mine & (F.col(key) <= bounds[value].at) if value in bounds else mine)
    return df.where(keep)


def draw(df: DataFrame, n: int, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """``n`` rows without replacement, all rows if there are no more than that."""
    ordinal = _md5_ordinal(key, seed)
    bounds = key_bounds(df, ordinal, lambda *_: n)
    return df.where(_up_to(df, ordinal, bounds[0])) if bounds else df


def stratified_flag(
    df: DataFrame, test_size: float, seed: int = 42, key: str = "doc_id", label: str = "label"
) -> DataFrame:
    """Add ``is_test``: in each class the same share of rows, rounded half up.

    Rows without a label are a class; rows without a key are never drawn.
    """
    ordinal = _md5_ordinal(key, seed)
    quotas: dict[object, int] = {}

    def wanted(value: object, n: int) -> int:
        quotas[value] = int(test_size * n + 0.5)
        return quotas[value]

    bounds = key_bounds(df, ordinal, wanted, F.col(label))
    chosen = F.lit(False)
    for value, quota in quotas.items():
        mine = F.col(label).eqNullSafe(F.lit(value))
        if value in bounds:
            chosen = F.when(mine, _up_to(df.where(mine), ordinal, bounds[value])).otherwise(chosen)
        elif quota > 0:
            chosen = chosen | mine
    return df.withColumn("is_test", chosen)


def stratified_split(
    df: DataFrame, test_size: float, seed: int = 42, key: str = "doc_id", label: str = "label"
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` by :func:`stratified_flag`."""
    flagged = stratified_flag(df, test_size, seed, key, label)
    return flagged.where(~F.col("is_test")).drop("is_test"), flagged.where("is_test").drop(
        "is_test"
    )
