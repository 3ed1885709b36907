"""Current state out of change events.

The patch fold keeps, per key, the latest value of each column together with
its position, the position of the last delete, and the last event. In mixed
feeds, where a column ``full`` tells whole rows from patches, it keeps the
position of the last whole row too, before which nothing counts: a null in a
whole row clears, a null in a patch does not. Each is a maximum, so partial folds merge in any order and any number of times: the same
aggregate serves a batch, a micro-batch and their union, pre-aggregates before
the shuffle, and gives the same answer for replayed or late events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import first_of

DELETE = "D"
CLEARED = "cleared"  # optional column of a patch feed: names of the columns it sets to null
FULL = "full"  # optional column of a mixed feed: whether the event is a whole row


def latest_rows(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Full-row feeds: the last event of a key is its state, unless it is a delete."""
    last = first_of(events, keys, [F.col(c).desc_nulls_last() for c in order])
    return last.filter(F.col("op") != DELETE)


def _position(order: list[str]) -> Column:
    return F.struct(*order)


def carries(events: DataFrame, column: str) -> Column:
    """Whether an event says something of ``column``: a value, that it is cleared, or in a whole row anything."""
    said = F.col(column).isNotNull()
    if CLEARED in events.columns:
        said = said | F.coalesce(F.array_contains(CLEARED, column), F.lit(False))
    if FULL in events.columns:
        said = (said | is_full()) & ~F.col("op").eqNullSafe(DELETE)
    return said


def is_full() -> Column:
    """Whether an event of a mixed feed is a whole row; a delete is none."""
    return F.coalesce(F.col(FULL), F.lit(False)) & ~F.col("op").eqNullSafe(DELETE)


def fold_partial(events: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Fold events to one mergeable state row per key."""
    at = _position(order)
    sums = [
        F.max(F.struct(at.alias("at"), F.col("op"))).alias("last"),
        F.max(F.when(F.col("op") == DELETE, at)).alias("deleted_at"),
    ]
    if FULL in events.columns:
        sums.append(F.max(F.when(is_full(), at)).alias("reset_at"))
    for c in columns:
        value = F.struct(at.alias("at"), F.col(c).alias("value"))
        sums.append(F.max(F.when(carries(events, c), value)).alias(f"s_{c}"))
    return events.groupBy(*keys).agg(*sums)


def fold_merge(states: DataFrame, keys: list[str]) -> DataFrame:
    """Merge state rows of the same key."""
    rest = [c for c in states.columns if c not in keys]
    return states.groupBy(*keys).agg(*[F.max(c).alias(c) for c in rest])


def fold_result(states: DataFrame, keys: list[str], columns: list[str], keep: list[str] = ()) -> DataFrame:
    """Live rows: values older than the last delete or whole row do not come back."""
    out = []
    for c in columns:
        alive = F.col("deleted_at").isNull() | (F.col(f"s_{c}.at") > F.col("deleted_at"))
        if "reset_at" in states.columns:
            alive = alive & (F.col("reset_at").isNull() | (F.col(f"s_{c}.at") >= F.col("reset_at")))
        out.append(F.when(alive, F.col(f"s_{c}.value")).alias(c))
    live = states.filter(F.col("last.op") != DELETE)
    return live.select(*keys, *out, *[F.col(f"last.at.{k}").alias(k) for k in keep])


def fold_patches(
    events: DataFrame, keys: list[str], order: list[str], columns: list[str], keep: list[str] = ()
) -> DataFrame:
    """Partial-row and mixed feeds: latest value said of each column since the last delete or whole row."""
    return fold_result(fold_partial(events, keys, order, columns), keys, columns, keep)
