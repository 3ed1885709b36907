"""Change events out of two snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.fold import CLEARED


def snapshot_diff(
    old: DataFrame, new: DataFrame, keys: list[str], columns: list[str], patch: bool = False
) -> DataFrame:
    """I, U and D events that turn ``old`` into ``new``; both hold one row per key.

    Columns are compared null-safely. A delete carries its key alone. With
    ``patch`` an update carries only the columns that changed, and ``cleared``
    names those that changed to null (null where there are none): a null value
    alone means "unchanged".
    """
    before = old.select(*keys, F.struct(*columns).alias("_old"))
    after = new.select(*keys, F.struct(*columns).alias("_new"))
    both = before.join(after, keys, "full")
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    op = (
        F.when(F.col("_old").isNull(), "I")
        .when(F.col("_new").isNull(), "D")
        .when(~same, "U")
    )
    out = []
    for c in columns:
        value = F.col(f"_new.{c}")
        if patch:
            unchanged = (F.col("op") == "U") & F.col(f"_old.{c}").eqNullSafe(value)
            value = F.when(~unchanged, value)
        out.append(value.alias(c))
    if patch:
        emptied = [
            F.when(F.col(f"_old.{c}").isNotNull() & F.col(f"_new.{c}").isNull(), F.lit(c)) for c in columns
        ]
        names = F.array_compact(F.array(*emptied))
        out.append(F.when((F.col("op") == "U") & (F.size(names) > 0), names).alias(CLEARED))
    return both.withColumn("op", op).filter(F.col("op").isNotNull()).select("op", *keys, *out)
