"""Joins between child and parent tables, and as of a point in time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.fold import DELETE
from tidemark.operators.ordered import Along, along
from tidemark.operators.skew import Skew, estimated_bytes, profile, replicate, spread


def _broadcast_limit(df: DataFrame) -> int:
    spark = df.sparkSession
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if limit.startswith("-"):
        return -1
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)


def will_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst's own size check lets ``df`` be broadcast."""
    return estimated_bytes(df) <= _broadcast_limit(df)


def with_parent(
    child: DataFrame,
    parent: DataFrame,
    on: list[str],
    how: str = "inner",
    skew: Skew | None = None,
    rows: DataFrame | None = None,
) -> DataFrame:
    """Equi-join a child with its parent; ``how``: inner, left, left_semi or left_anti.

    A parent that Catalyst broadcasts by its size needs no shuffle and no salt.
    Otherwise child rows of hot keys are salted over many tasks and only the
    few parent rows of those keys are replicated. ``rows`` is what the child was
    before joins that kept its rows: its keys are profiled without running them.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a parent join cannot be {how!r}")
    if skew is None:
        if child.isStreaming or will_broadcast(parent):
            return child.join(parent, on, how)
        skew = profile(child if rows is None else rows, on)
    if how in ("left_semi", "left_anti"):
        # only existence matters: repeated keys are reduced before they are shuffled
        parent = parent.select(*on).distinct()
    if not skew:
        return child.join(parent, on, how)
    salted = spread(child, on, skew).join(replicate(parent, on, skew), [*on, "_salt"], how)
    return salted.drop("_salt")


def orphans(child: DataFrame, parent: DataFrame, on: list[str], **options) -> DataFrame:
    """Child rows whose parent is missing; a null reference is missing too."""
    return with_parent(child, parent.select(*on), on, "left_anti", **options)


def known(child: DataFrame, parent: DataFrame, on: list[str], **options) -> DataFrame:
    return with_parent(child, parent.select(*on), on, "left_semi", **options)


def as_of(
    facts: DataFrame,
    history: DataFrame,
    keys: list[str],
    fact_time: str,
    version_time: str,
    columns: dict[str, str],
    skew: Skew | None = None,
    tie: list[str] = (),
) -> DataFrame:
    """Each fact with the version in force at its time, null where there is none.

    Of versions that begin at one instant the one with the greatest ``tie``
    columns is in force, such as its broker partition and offset.

    ``columns`` maps history columns to their names in the result. Versions and
    facts are laid into one ordered sequence per key, where a fact takes the
    latest version before it: every row is handled once, where an interval join
    would compare all versions of a key with all its facts. If ``history`` has
    an ``op`` column, a delete leaves no version in force.
    """
    marks = facts.withColumns({"_at": F.col(fact_time), "_side": F.lit(1)})
    later = F.struct(*tie).alias("_tie") if tie else F.lit(0).alias("_tie")
    gone = F.col("op") == DELETE if "op" in history.columns else F.lit(False)
    version = F.struct(gone.alias("gone"), *[F.col(c).alias(n) for c, n in columns.items()])
    steps = history.select(
        *keys, F.col(version_time).alias("_at"), F.lit(0).alias("_side"), later, version.alias("_version")
    )
    merged = marks.unionByName(steps, allowMissingColumns=True)
    filled = along(merged, keys, ["_at", "_side", "_tie"], Along(latest={"_inforce": F.col("_version")}), skew)
    taken = {
        n: F.when(~F.col("_inforce.gone"), F.col(f"_inforce.{n}")) for n in columns.values()
    }
    return filled.filter(F.col("_side") == 1).select(
        *facts.columns, *[c.alias(n) for n, c in taken.items()]
    )
