"""Counts and totals for reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(value: Column) -> Column:
    """Cents are exact in decimal, so a total does not depend on the order of adding."""
    return value.cast(MONEY)


def change_profile(raw: DataFrame) -> DataFrame:
    return raw.groupBy("partition_date", "op").agg(F.count(F.lit(1)).alias("events"))


def totals_with_subtotals(df: DataFrame, levels: list[str], amount: Column) -> DataFrame:
    """Row count and sum at every level of the hierarchy; null marks a subtotal."""
    return df.rollup(*levels).agg(
        F.count(F.lit(1)).alias("n"), F.sum(money(amount)).alias("total")
    )


def freshness(df: DataFrame, by: list[str], changed: str, arrived: str) -> DataFrame:
    """Newest change per group and exact percentiles of the delay in whole seconds.

    Delays are counted before they are ranked. A running sum over one row per
    distinct second, which spills if it must, tells which delays stand at a
    percentile's two neighbouring ranks.
    """
    delay = F.floor((F.unix_micros(arrived) - F.unix_micros(changed)) / F.lit(1000000))
    counted = df.groupBy(*by, delay.alias("delay")).agg(
        F.max(changed).alias("newest"), F.count(F.lit(1)).alias("n")
    )
    group = Window.partitionBy(*by)
    known = F.when(F.col("delay").isNotNull(), F.col("n")).otherwise(0)
    ranked = counted.withColumns(
        {"upto": F.sum(known).over(group.orderBy("delay")), "known": F.sum(known).over(group)}
    )
    out = {"newest_change": F.max("newest"), "events": F.sum("n")}
    for name, share in (("delay_p50", 0.5), ("delay_p95", 0.95), ("delay_p99", 0.99)):
        place = (F.col("known") - 1) * F.lit(share)
        low, high = (F.min(F.when(F.col("upto") > r, F.col("delay"))) for r in (F.floor(place), F.ceil(place)))
        out[name] = low + (high - low) * F.max(place - F.floor(place))
    return ranked.groupBy(*by).agg(*[c.alias(n) for n, c in out.items()])


def event_rates(df: DataFrame, at: str, width: str, by: list[str]) -> DataFrame:
    """Events per tumbling window; the same on a table and on a watermarked stream."""
    return (
        df.groupBy(F.window(at, width).alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "events")
    )
