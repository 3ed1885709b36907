"""Values taken from earlier or later rows of the same key.

Window functions put all rows of a key into one task. Here a hot key is cut
into slices of its ordering column; each slice is a window partition of its
own, and one summary row per slice supplies what crosses the cut.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import Skew, is_hot, profile, with_slice


@dataclass(frozen=True)
class Along:
    """What to add to each row; every mapping is new column name -> expression."""

    number: str = ""  # 1-based position within the key
    following: dict[str, Column] = field(default_factory=dict)  # value on the next row
    preceding: dict[str, Column] = field(default_factory=dict)  # value on the previous row
    latest: dict[str, Column] = field(default_factory=dict)  # last non-null, this row included
    before: dict[str, Column] = field(default_factory=dict)  # last non-null before this row


def _packed(values: dict[str, Column]) -> Column:
    return F.struct(*[c.alias(n) for n, c in values.items()])


def _in_window(df: DataFrame, parts: list[str], order: list[str], want: Along) -> DataFrame:
    window = Window.partitionBy(*parts).orderBy(*order)
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prior = window.rowsBetween(Window.unboundedPreceding, -1)
    added = {}
    if want.number:
        added[want.number] = F.row_number().over(window).cast("long")
    if want.following:
        added["_following"] = F.lead(_packed(want.following)).over(window)
    if want.preceding:
        added["_preceding"] = F.lag(_packed(want.preceding)).over(window)
    for name, value in want.latest.items():
        added[name] = F.last(value, ignorenulls=True).over(upto)
    for name, value in want.before.items():
        added[name] = F.last(value, ignorenulls=True).over(prior)
    return df.withColumns(added)


def _edges(df: DataFrame, keys: list[str], order: list[str], want: Along) -> DataFrame:
    """One row per slice of a hot key: what the slices before and after it hold."""
    position = F.struct(*order)
    carried = {**want.latest, **want.before}
    sums = [F.count(F.lit(1)).alias("_n")]
    if want.following:
        sums.append(F.min_by(_packed(want.following), position).alias("_head"))
    if want.preceding:
        sums.append(F.max_by(_packed(want.preceding), position).alias("_tail"))
    for name, value in carried.items():
        sums.append(F.max_by(value, F.when(value.isNotNull(), position)).alias(f"_c_{name}"))
    slices = df.groupBy(*keys, "_slice").agg(*sums)

    window = Window.partitionBy(*keys).orderBy("_slice")
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    out = [*keys, "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base")]
    if want.following:
        out.append(F.lead("_head").over(window).alias("_next_head"))
    if want.preceding:
        out.append(F.lag("_tail").over(window).alias("_previous_tail"))
    for name in carried:
        out.append(F.last(f"_c_{name}", ignorenulls=True).over(earlier).alias(f"_e_{name}"))
    return slices.select(*out)


def _unpack(df: DataFrame, want: Along) -> DataFrame:
    added = {n: F.col("_following")[n] for n in want.following}
    added |= {n: F.col("_preceding")[n] for n in want.preceding}
    return df.withColumns(added).drop("_following", "_preceding") if added else df


def _sliced(df: DataFrame, keys: list[str], order: list[str], want: Along, skew: Skew) -> DataFrame:
    """One window for all rows, keys that are not hot in slice 0; what crosses a cut is joined to it.

    The input is read twice: for the window, and its hot keys for the edges.
    """
    rows = with_slice(df, keys, order[0], skew)
    edges = _edges(rows.filter(is_hot(keys, skew)), keys, order, want)
    inside = _in_window(rows, [*keys, "_slice"], order, want)

    place = [*keys, "_slice"]
    renamed = edges.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(place)})
    match = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(place)])
    joined = inside.join(renamed, match, "left")

    patched = {}
    if want.number:
        patched[want.number] = F.col(want.number) + F.coalesce("_base", F.lit(0))
    if want.following:
        patched["_following"] = F.coalesce("_following", "_next_head")
    if want.preceding:
        patched["_preceding"] = F.coalesce("_preceding", "_previous_tail")
    for name in (*want.latest, *want.before):
        patched[name] = F.coalesce(name, f"_e_{name}")
    return joined.withColumns(patched).drop("_slice", *renamed.columns)


def along(
    df: DataFrame, keys: list[str], order: list[str], want: Along, skew: Skew | None = None
) -> DataFrame:
    """Add ``want`` to every row, in ``order`` within ``keys``.

    ``order`` must be total within a key and start with a timestamp, date or
    integer column; nulls sort first.
    """
    if skew is None:
        skew = profile(df, keys, order[0])
    if not skew:
        return _unpack(_in_window(df, keys, order, want), want)
    return _unpack(_sliced(df, keys, order, want, skew), want)

