"""The transform shared by batch and streaming ingestion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.parse import CORRUPT, decode, instant, is_fallback, partition_day
from tidemark.spec import TableSpec

PARTITIONS = ["partition_date", "op"]


def to_raw(
    records: DataFrame,
    spec: TableSpec,
    *,
    lineage: bool = False,
    corrupt: bool = False,
    extra: bool = False,
) -> DataFrame:
    """Broker records of one table as typed rows with their partition date."""
    rows = decode(records, spec.schema, lineage=lineage, corrupt=corrupt, extra=extra)
    if spec.parsed_date:
        rows = rows.withColumn(spec.parsed_date, F.try_to_date(spec.partition_source))
    rows = rows.withColumn("partition_date", partition_day(spec.partition_source))
    if spec.stamp:
        rows = rows.withColumn(spec.stamp, F.current_timestamp())
    return rows


def batch_metrics(rows: DataFrame, event_time: str = "change_ts") -> list:
    """Aggregates describing a batch; use with ``observe`` or ``agg``.

    Times are microseconds, because progress reports cut timestamps to seconds.
    """
    malformed = F.col(CORRUPT).isNotNull() if CORRUPT in rows.columns else F.lit(False)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(is_fallback()).alias("fallback_rows"),
        F.count_if(malformed).alias("malformed_rows"),
        F.unix_micros(F.min(instant(event_time))).alias("min_change_us"),
        F.unix_micros(F.max(instant(event_time))).alias("max_change_us"),
    ]
