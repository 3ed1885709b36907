"""Versions of a key and images around a change.

Events must be free of redelivered copies (see ``dedup``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.fold import DELETE, FULL, carries, is_full
from tidemark.operators.ordered import Along, along
from tidemark.operators.skew import Skew


def versions(
    events: DataFrame, keys: list[str], order: list[str], skew: Skew | None = None
) -> DataFrame:
    """Type-2 history: a version lasts until the next event; a delete ends it and opens none."""
    start = order[0]
    want = Along(number="version", following={"valid_to": F.col(start)})
    rows = along(events, keys, order, want, skew).filter(F.col("op") != DELETE)
    return rows.withColumnRenamed(start, "valid_from").withColumn(
        "is_current", F.col("valid_to").isNull()
    )


def folded_versions(
    events: DataFrame, keys: list[str], order: list[str], columns: list[str], skew: Skew | None = None
) -> DataFrame:
    """Type-2 history of a feed of patches, or of patches and whole rows (``FULL``): each version is the folded row.

    Every event opens a version with all ``columns`` as they are after it, until the next event; a delete
    ends one and opens none.
    """
    start, at = order[0], F.struct(*order)
    mixed = FULL in events.columns
    latest = {f"_v_{c}": _stamped(events, c, at) for c in columns} | {"_gone": F.when(F.col("op") == DELETE, at)}
    if mixed:
        latest["_reset"] = F.when(is_full(), at)
    want = Along(number="version", following={"valid_to": F.col(start)}, latest=latest)
    rows = along(events, keys, order, want, skew).filter(~F.col("op").eqNullSafe(DELETE))
    folded = {}
    for c in columns:
        stamped = F.col(f"_v_{c}")
        alive = F.col("_gone").isNull() | (stamped["at"] > F.col("_gone"))
        if mixed:
            alive = alive & (F.col("_reset").isNull() | (stamped["at"] >= F.col("_reset")))
        folded[c] = F.when(alive, stamped["value"])
    rows = rows.withColumns(folded).drop(*latest, FULL)
    return rows.withColumnRenamed(start, "valid_from").withColumn("is_current", F.col("valid_to").isNull())


def number_events(
    events: DataFrame, keys: list[str], order: list[str], name: str = "version", skew: Skew | None = None
) -> DataFrame:
    return along(events, keys, order, Along(number=name), skew)


def images(
    events: DataFrame,
    keys: list[str],
    order: list[str],
    columns: list[str],
    patch: bool = False,
    skew: Skew | None = None,
) -> DataFrame:
    """Each event with its columns before (``old_*``) and after (``new_*``) the change.

    Full-row feeds compare with the previous event. Patch feeds compare running
    states: null means unchanged, and a delete clears what came before it.
    """
    deleted = F.col("op") == DELETE
    if not patch:
        want = Along(preceding={"_op": F.col("op"), **{f"old_{c}": F.col(c) for c in columns}})
        rows = along(events, keys, order, want, skew)
        was_live = F.col("_op").isNotNull() & (F.col("_op") != DELETE)
        shown = {f"old_{c}": F.when(was_live, F.col(f"old_{c}")) for c in columns}
        shown |= {f"new_{c}": F.when(~deleted, F.col(c)) for c in columns}
        return rows.withColumns(shown).drop("_op", *columns)

    at = F.struct(*order)
    kept = {f"_v_{c}": _stamped(events, c, at) for c in columns}
    want = Along(
        latest={f"_new{n}": v for n, v in kept.items()} | {"_new_gone": F.when(deleted, at)},
        before={f"_old{n}": v for n, v in kept.items()} | {"_old_gone": F.when(deleted, at)},
    )
    rows = along(events, keys, order, want, skew)
    shown = {}
    for side in ("old", "new"):
        gone = F.col(f"_{side}_gone")
        for c in columns:
            stamped = F.col(f"_{side}_v_{c}")
            alive = gone.isNull() | (stamped["at"] > gone)
            shown[f"{side}_{c}"] = F.when(alive, stamped["value"])
    helpers = [n for n in rows.columns if n.startswith(("_old_", "_new_"))]
    return rows.withColumns(shown).drop(*helpers, *columns)


def _stamped(events: DataFrame, column: str, at: Column) -> Column:
    value = F.struct(at.alias("at"), F.col(column).alias("value"))
    return F.when(carries(events, column), value)
