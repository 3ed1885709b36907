"""Kafka topics as streams, and as tables over a range of offsets or times.

Needs the Spark Kafka connector on the classpath.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.spec import TableSpec

DEFAULT_SERVERS = "localhost:9092"


def stream_options(
    spec: TableSpec,
    servers: str = DEFAULT_SERVERS,
    group: str | None = None,
    max_offsets: int | None = None,
    min_partitions: int | None = None,
    pattern: str | None = None,
    start_ms: int | None = None,
) -> dict[str, str]:
    """Earliest on the first start, the checkpoint afterwards; lost offsets are tolerated.

    ``pattern`` subscribes to every topic whose name matches, so that one query
    takes several feeds of a table. ``start_ms`` begins the first start at that
    broker time, or at the end of a topic without records since.
    """
    topics = {"subscribePattern": pattern} if pattern else {"subscribe": spec.topic}
    begin = {"startingOffsets": "earliest"}
    if start_ms is not None:
        begin = {"startingTimestamp": str(start_ms), "startingOffsetsByTimestampStrategy": "latest"}
    options = {
        "kafka.bootstrap.servers": servers,
        **topics,
        "kafka.group.id": group or f"tidemark_{spec.table}_cdc",
        **begin,
        "failOnDataLoss": "false",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def read_stream(spark: SparkSession, spec: TableSpec, **settings) -> DataFrame:
    return spark.readStream.format("kafka").options(**stream_options(spec, **settings)).load()


def lost_offsets(records: DataFrame) -> DataFrame:
    """Gaps in the offsets of landed records, by topic and partition: how many and how many offsets they span.

    With ``failOnDataLoss`` off a stream goes on past offsets that the broker no
    longer has. They show as missing between the first and the last offset that
    were landed; compacted and transactional topics have such gaps of their own.
    Counts and ends pre-aggregate, so a partition that holds most rows is no burden.
    """
    seen = records.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.count_distinct("offset").alias("landed"),
    )
    return seen.withColumn("lost", F.col("last_offset") - F.col("first_offset") + 1 - F.col("landed"))


def offset_range_options(topic: str, servers: str, ranges: dict[int, tuple[int, int]]) -> dict[str, str]:
    """Batch options for ``start <= offset < end`` per partition."""
    starts = {str(p): a for p, (a, _) in ranges.items()}
    ends = {str(p): b for p, (_, b) in ranges.items()}
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": json.dumps({topic: starts}),
        "endingOffsets": json.dumps({topic: ends}),
    }


def time_range_options(topic: str, servers: str, start_ms: int, end_ms: int) -> dict[str, str]:
    """Batch options for ``start <= broker time < end`` on every partition, however many there are."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingTimestamp": str(start_ms),
        "endingTimestamp": str(end_ms),
        "startingOffsetsByTimestampStrategy": "latest",
    }


def read_range(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("kafka").options(**options).load()
