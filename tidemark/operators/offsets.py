"""Ranges of broker offsets: what was landed, what is missing, what is new."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PLACE = ["topic", "partition"]
# Powers of two.
STRETCH = 1 << 20  # offsets that one window holds
SHORT = 1 << 10  # offsets among whose ranges a record is looked up
WORD = 64
RANGES = "topic string, partition int, first long, last long"


def _part(offset: Column, size: int) -> Column:
    """Which stretch of ``size`` offsets one lies in, exact for any of them."""
    return F.shiftright(offset.cast("long"), size.bit_length() - 1)


def _numbered(rows: DataFrame, parts: list[str], first: Column, last: Column) -> DataFrame:
    """Number the runs of ranges that follow on or overlap, in order of ``first``."""
    window = Window.partitionBy(*parts).orderBy(first)
    reached = F.max(last).over(window.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reached.isNull() | (first > reached + 1), 1).otherwise(0)
    numbered = rows.withColumn("_begins", begins)
    return numbered.withColumn("_run", F.sum("_begins").over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def merge_ranges(ranges: DataFrame) -> DataFrame:
    """The same offsets (``RANGES``) in as few ranges as can be: they neither overlap nor touch."""
    runs = _numbered(ranges, PLACE, F.col("first"), F.col("last"))
    merged = runs.groupBy(*PLACE, "_run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return merged.drop("_run")


def _runs(mask: Column) -> Column:
    """The runs of set bits of a word of 64, as an array of (low, high)."""
    begins = mask.bitwiseAND(F.bitwise_not(F.shiftleft(mask, 1)))
    ends = mask.bitwiseAND(F.bitwise_not(F.shiftrightunsigned(mask, 1)))
    bits = F.sequence(F.lit(0), F.lit(WORD - 1))
    low = F.filter(bits, lambda i: F.getbit(begins, i) == 1)
    high = F.filter(bits, lambda i: F.getbit(ends, i) == 1)
    return F.arrays_zip(low.alias("low"), high.alias("high"))


def landed_ranges(records: DataFrame) -> DataFrame:
    """Ranges of consecutive offsets in ``records`` (topic, partition, offset); repeated ones count once.

    Offsets are first gathered as bits of words of 64, before any shuffle where they lie together. The
    runs of bits are put in order within stretches of a partition, so that a partition of most records
    is dealt over many tasks; only ranges are merged across stretches.
    """
    bit = F.expr(f"shiftleft(1L, cast(offset & {WORD - 1} as int))")
    words = records.where("offset is not null").groupBy(*PLACE, _part(F.col("offset"), WORD).alias("word")).agg(F.bit_or(bit).alias("mask"))
    pieces = words.select(*PLACE, "word", F.explode(_runs(F.col("mask"))).alias("run")).select(
        *PLACE, (F.col("word") * WORD + F.col("run.low")).alias("first"), (F.col("word") * WORD + F.col("run.high")).alias("last")
    )
    pieces = pieces.withColumn("stretch", _part(F.col("first"), STRETCH))
    runs = _numbered(pieces, [*PLACE, "stretch"], F.col("first"), F.col("last"))
    merged = runs.groupBy(*PLACE, "stretch", "_run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return merge_ranges(merged.select(*PLACE, "first", "last"))


def missing_ranges(ranges: DataFrame) -> DataFrame:
    """The offsets between ranges of a partition, as ranges."""
    window = Window.partitionBy(*PLACE).orderBy("first")
    before = merge_ranges(ranges).withColumn("_before", F.lag("last").over(window))
    return before.where("_before is not null").select(
        *PLACE, (F.col("_before") + 1).alias("first"), (F.col("first") - 1).alias("last")
    )


def _cut(merged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Disjoint ranges as the stretches that they hold whole, and what is left of them cut by short stretches.

    A range has a row per ``STRETCH`` offsets, and at its ends rows of ``SHORT``: few rows also for
    ranges that hold a topic of years.
    """
    first, last = F.col("first"), F.col("last")
    # the first whole stretch and the one after the last; none unless the first is less
    ranges = merged.withColumns({"_start": _part(first + (STRETCH - 1), STRETCH), "_end": _part(last + 1, STRETCH)})
    whole = ranges.where("_start < _end").select(*PLACE, F.explode(F.sequence(F.col("_start"), F.col("_end") - 1)).alias("_stretch"))
    some = F.col("_start") < F.col("_end")
    piece = lambda low, high: F.struct(low.alias("low"), high.alias("high"))
    ends = F.array(piece(first, F.col("_start") * STRETCH - 1), piece(F.col("_end") * STRETCH, last))
    rest = ranges.select(*PLACE, F.explode(F.when(some, ends).otherwise(F.array(piece(first, last)))).alias("_e")).where("_e.low <= _e.high")
    short = F.sequence(_part(F.col("_e.low"), SHORT), _part(F.col("_e.high"), SHORT))
    return whole, rest.select(*PLACE, F.col("_e.low").alias("_first"), F.col("_e.high").alias("_last"), F.explode(short).alias("_short"))


def _held(records: DataFrame, ranges: DataFrame, columns: tuple[str, str, str]) -> DataFrame:
    """``records`` with ``_held``: whether their offset lies in one of ``ranges``.

    Two equi-joins by stretches of offsets: a record meets the ranges of its short stretch only, a
    stretch is no hot key, and ranges that are few enough are broadcast, so that records stay where they are.
    """
    topic, partition, offset = columns
    whole, rest = _cut(merge_ranges(ranges))
    names = {"topic": "_topic", "partition": "_partition"}
    whole, rest = whole.withColumnsRenamed(names), rest.withColumnsRenamed(names)
    at = F.col(offset)
    place = F.col(topic).eqNullSafe(F.col("_topic")) & F.col(partition).eqNullSafe(F.col("_partition"))
    found = records.join(whole, place & (_part(at, STRETCH) == F.col("_stretch")), "left")
    found = found.select(*records.columns, F.col("_stretch").isNotNull().alias("_whole"))
    found = found.join(rest, place & (_part(at, SHORT) == F.col("_short")) & at.between(F.col("_first"), F.col("_last")), "left")
    return found.select(*records.columns, (F.col("_whole") | F.col("_short").isNotNull()).alias("_held"))


def outside(records: DataFrame, ranges: DataFrame, columns: tuple[str, str, str] = ("topic", "partition", "offset")) -> DataFrame:
    """``records`` whose offset (topic, partition and offset are named by ``columns``) lies in none of ``ranges``."""
    return _held(records, ranges, columns).where(~F.col("_held")).drop("_held")


def inside(records: DataFrame, ranges: DataFrame, columns: tuple[str, str, str] = ("topic", "partition", "offset")) -> DataFrame:
    """``records`` whose offset lies in one of ``ranges``; null offsets lie in none."""
    return _held(records, ranges, columns).where("_held").drop("_held")
