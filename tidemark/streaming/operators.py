"""Streaming forms of deduplication, rates and joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import with_parent
from tidemark.operators.rollup import event_rates
from tidemark.operators.skew import NO_SKEW, Skew, replicate, spread


def drop_duplicates(
    events: DataFrame, keys: list[str], event_time: str, delay: str, spread_by: list[str] | None = None
) -> DataFrame:
    """Drop copies that arrive within ``delay`` of each other.

    With ``spread_by`` (columns that differ between copies, such as the offset)
    copies are first reduced in as many parts of each group as the stream has
    tasks, so that a group holding much of the stream is not reduced by one.
    """
    marked = events.withWatermark(event_time, delay)
    if spread_by:
        tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salt = F.pmod(F.xxhash64(*spread_by), F.lit(tasks))
        marked = marked.withColumn("_salt", salt)
        marked = marked.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return marked.dropDuplicatesWithinWatermark(keys)


def rates(events: DataFrame, event_time: str, delay: str, width: str, by: list[str]) -> DataFrame:
    """Closed tumbling windows of a stream."""
    return event_rates(events.withWatermark(event_time, delay), event_time, width, by)


def join_within(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    delay: str,
    earliest: str,
    latest: str,
    skew: Skew = NO_SKEW,
) -> DataFrame:
    """Stream-stream join: ``right_time`` within [left_time + earliest, left_time + latest].

    Both sides keep state only as long as the interval and the delay demand.
    ``skew`` (profiled on landed data) salts the right rows of hot keys.
    """
    a = replicate(left.withWatermark(left_time, delay), [key], skew)
    b = spread(right.withWatermark(right_time, delay), [key], skew)
    b = b.withColumnsRenamed({key: "_key", "_salt": "_right_salt"})
    within = (
        (F.col(key) == F.col("_key"))
        & (F.col("_salt") == F.col("_right_salt"))
        & (F.col(right_time) >= F.col(left_time) + F.expr(f"INTERVAL {earliest}"))
        & (F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {latest}"))
    )
    return a.join(b, within).drop("_key", "_salt", "_right_salt")


def left_within(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    delay: str,
    earliest: str,
    latest: str,
) -> DataFrame:
    """As ``join_within``, and left rows without a partner once the watermark says that none can come.

    Both sides drop rows that are later than ``delay`` (counted in the progress as dropped by watermark)
    and state that can no longer match, so the state holds the interval and the delay, not the stream. A
    left row lies in one task with its key's rows of that time: copies of it, as salting needs them, would
    each be found without a partner.
    """
    a = left.withWatermark(left_time, delay)
    b = right.withWatermark(right_time, delay).withColumnRenamed(key, "_key")
    within = (
        (F.col(key) == F.col("_key"))
        & (F.col(right_time) >= F.col(left_time) + F.expr(f"INTERVAL {earliest}"))
        & (F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {latest}"))
    )
    return a.join(b, within, "leftOuter").drop("_key")


def with_current_parent(
    parent: Callable[[SparkSession], DataFrame], on: list[str], write: Callable[[DataFrame, int], None], how: str = "left"
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` callback that joins each batch with the parent as it stands when the batch begins.

    ``parent`` opens its newest version; ``write`` takes the joined batch and its number and must replace
    what an earlier try of that number left. A parent too large to broadcast is met by the batch's own
    skew: its hot keys are found in the batch, which is read twice for that, and salted.
    """

    def run(batch: DataFrame, epoch: int) -> None:
        write(with_parent(batch, parent(batch.sparkSession), on, how), epoch)

    return run
