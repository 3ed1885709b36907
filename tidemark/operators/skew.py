"""Find hot keys with one bounded pass, and spread their rows.

A table is cut into parts that a task can hold: one for every ``TASK_BYTES`` it
reads, at least ``SHARE`` and at most ``MOST`` of them. A key is hot when it
holds at least one part, so there are no more hot keys than parts. The pass
returns one row: the hot key hashes and the split points of the ordering
column. Both come from mergeable sketches; they decide only where rows are
processed, never what is returned. They are frozen into the plan as literals,
so a task that is run again places its rows as before. Every input takes the
same pass and the same plans, whatever its size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE = 512
MOST = 8192  # split points and hot keys are literals of the plan
TASK_BYTES = 128 << 20
_TRACKED = 8  # sketch entries a part: the error, 3.5 / (8 * parts) of the rows, is below a part
_MERGERS = 256  # intermediate tasks merging the sketches of all scan tasks
_RANK_K = 2048


@dataclass(frozen=True)
class Skew:
    hot: tuple[int, ...] = ()
    splits: tuple[int, ...] = ()
    parts: int = SHARE

    def __bool__(self) -> bool:
        return bool(self.hot)


NO_SKEW = Skew()


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate, the figure it compares with the broadcast threshold."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def scanned_bytes(df: DataFrame) -> int:
    """Estimated size of what ``df`` reads: unlike the estimate of a join, never a product."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def parts_of(size: int) -> int:
    """How many parts a table of ``size`` bytes has: a power of two."""
    wanted = max(SHARE, -(-size // TASK_BYTES))
    return min(MOST, 1 << (wanted - 1).bit_length())


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def is_hot(keys: list[str], skew: Skew) -> Column:
    return key_hash(keys).isin(list(skew.hot)) if skew else F.lit(False)


def _micros(order: Column, kind: str) -> Column:
    if kind.startswith("timestamp"):
        return F.unix_micros(order.cast("timestamp"))
    if kind == "date":
        return F.unix_date(order).cast("long")
    return order.cast("long")


def profile(df: DataFrame, keys: list[str], order: str | None = None) -> Skew:
    """Hot keys of ``df`` and, given ``order``, split points of that column."""
    cut = parts_of(scanned_bytes(df))
    hashed = df.select(
        key_hash(keys).alias("h"),
        (_micros(F.col(order), dict(df.dtypes)[order]) if order else F.lit(0).cast("long")).alias("o"),
    )
    parts = hashed.groupBy(F.expr(f"pmod(spark_partition_id(), {_MERGERS})").alias("merger")).agg(
        F.expr(f"approx_top_k_accumulate(h, {_TRACKED * cut})").alias("top"),
        F.kll_sketch_agg_bigint("o", F.lit(_RANK_K)).alias("ranks"),
        F.count(F.lit(1)).alias("n"),
        F.count("o").alias("ordered"),
    )
    merged = parts.groupBy(F.lit(True)).agg(  # no row, rather than a combination of nothing, for an empty table
        F.expr("approx_top_k_combine(top)").alias("top"),
        F.kll_merge_agg_bigint("ranks").alias("ranks"),
        F.sum("n").alias("n"),
        F.sum("ordered").alias("ordered"),
    )
    found = merged.select(
        "n",
        F.expr(f"approx_top_k_estimate(top, {cut})").alias("top"),
        F.when(
            F.col("ordered") > 0,  # a sketch of nothing has no quantiles
            F.kll_sketch_get_quantile_bigint("ranks", F.lit([i / cut for i in range(1, cut)])),
        ).alias("splits"),
    ).first()
    if not found or not found["n"]:
        return NO_SKEW
    hot = tuple(t["item"] for t in found["top"] if t["count"] * cut >= found["n"])
    splits = tuple(sorted(set(found["splits"]))) if order and found["splits"] else ()
    return Skew(hot, splits, cut)


def with_slice(df: DataFrame, keys: list[str], order: str, skew: Skew, name: str = "_slice") -> DataFrame:
    """Add which stretch of the ordering column a row is in; 0 for keys that are not hot.

    Slices ascend with the column and hold about one part of all rows each.
    The stretch is found by halving: one projection per step, all in generated code.
    """
    last = 2**63 - 1
    splits = F.lit([*skew.splits, *[last] * (skew.parts - 1 - len(skew.splits))]).cast("array<bigint>")
    position = _micros(F.col(order), dict(df.dtypes)[order])
    found = df.withColumns({name: F.lit(0), "_position": F.when(is_hot(keys, skew), position)})
    step = skew.parts // 2
    while step:
        reached = F.get(splits, F.col(name) + F.lit(step - 1)) <= F.col("_position")
        found = found.withColumn(name, F.col(name) + F.when(reached, step).otherwise(0))
        step //= 2
    return found.drop("_position")


def _cost(column) -> int:
    """Order of reading cost: numbers and times, other plain types, text, nested types."""
    kind = column.dataType.simpleString()
    if kind in ("bigint", "int", "date", "timestamp", "timestamp_ntz"):
        return 0
    if kind == "string":
        return 2
    return 3 if "<" in kind else 1


def spread(df: DataFrame, keys: list[str], skew: Skew, name: str = "_salt") -> DataFrame:
    """Salt the rows of hot keys by their partition and two of their cheaper columns.

    Repeatable, unlike rand. The partition spreads rows that are equal in all
    their columns; few columns leave the others to be pruned.
    """
    cheap = sorted((f for f in df.schema.fields if f.name not in keys), key=_cost)
    picked = [f.name for f in cheap[:2] if "map<" not in f.dataType.simpleString()]
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *picked), F.lit(skew.parts)).cast("int")
    return df.withColumn(name, F.when(is_hot(keys, skew), salt).otherwise(F.lit(0)))


def replicate(df: DataFrame, keys: list[str], skew: Skew, name: str = "_salt") -> DataFrame:
    """Give the rows of hot keys every salt: a copy of a parent row for each part."""
    every = F.sequence(F.lit(0), F.lit(skew.parts - 1))
    return df.withColumn(name, F.explode(F.when(is_hot(keys, skew), every).otherwise(F.array(F.lit(0)))))
