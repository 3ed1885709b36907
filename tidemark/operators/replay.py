"""Select a part of the landed feed again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_offset(raw: DataFrame, ranges: dict[int, tuple[int, int]]) -> DataFrame:
    """Rows with ``start <= offset < end`` in each listed partition."""
    wanted = [
        (F.col("kafka_partition") == p) & (F.col("kafka_offset") >= a) & (F.col("kafka_offset") < b)
        for p, (a, b) in ranges.items()
    ]
    return raw.filter(reduce(lambda x, y: x | y, wanted, F.lit(False)))


def by_time(raw: DataFrame, start: str, end: str, column: str = "kafka_timestamp") -> DataFrame:
    """Rows with ``start <= time < end``."""
    kind = dict(raw.dtypes)[column]
    return raw.filter(
        (F.col(column) >= F.lit(start).cast(kind)) & (F.col(column) < F.lit(end).cast(kind))
    )
