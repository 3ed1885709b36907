"""One row out of many copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_of(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of every key.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so
    every task sends at most one row of a key, however many copies it holds.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def drop_redelivered(
    events: DataFrame, keys: list[str], order: list[str | Column], event_time: str = "change_ts"
) -> DataFrame:
    """Keep the first delivery of each (key, event time, op)."""
    return first_of(events, [*keys, event_time, "op"], order)
