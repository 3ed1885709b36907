"""The raw zone through its manifest: epochs, merges, replays and lost offsets."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.parse import LINEAGE_FIELDS
from tidemark.operators import replay
from tidemark.operators.ingest import to_raw
from tidemark.plans.feeds import EVENTS, records
from tidemark.plans.registry import query
from tidemark.session import scratch_path
from tidemark.sources.files import raw_schema
from tidemark.streaming.manifest import Manifest, replay_once
from tidemark.streaming.sinks import write_batch

SCHEMA = raw_schema(EVENTS, LINEAGE_FIELDS)
EPOCHS = 3

# Offsets of a partition follow on, and epochs hold a third of them each.
NUMBERED_SQL = f"""
numbered AS (
  SELECT *, CAST(event_id % 3 AS INTEGER) AS part, event_id // 3 AS place,
         event_id * {EPOCHS} // (SELECT max(event_id) + 1 FROM events) AS epoch
  FROM events
)
"""


def numbered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The feed with consecutive offsets in each partition, and with the epoch each record came in."""
    rows = records(spark, sf_dir)
    event = F.col("offset")
    top = rows.agg(F.max(event) + 1)
    epoch = F.floor(event * EPOCHS / top.scalar()).cast("int")
    dealt = rows.withColumn("epoch", epoch).withColumn("offset", F.floor(event / 3))
    return dealt.drop("epoch"), dealt


def land_epochs(spark: SparkSession, dealt: DataFrame, zone: str) -> Manifest:
    """Epochs are written side by side, as each lies in few parts of the feed, and committed one after the other."""
    manifest = Manifest(spark, zone)
    names = [f"generation=query/batch_id={epoch}" for epoch in range(EPOCHS)]

    def write(epoch: int) -> None:
        write_batch(to_raw(dealt.where(F.col("epoch") == epoch).drop("epoch"), EVENTS, lineage=True), f"{zone}/{names[epoch]}")

    with ThreadPoolExecutor(EPOCHS) as pool:
        # each thread has a copy of the local properties of its own
        for done in [pool.submit(inheritable_thread_target(write), epoch) for epoch in range(EPOCHS)]:
            done.result()
    for folder in names:
        manifest.add(folder)
    return manifest


@query(f"""
WITH {NUMBERED_SQL},
sizes AS (SELECT epoch, count(*) AS folder_rows FROM numbered GROUP BY epoch)
SELECT DISTINCT CAST(epoch AS INTEGER) AS epoch, CAST(ts AS DATE) AS day, folder_rows
FROM numbered JOIN sizes USING (epoch) WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'
""")
def epoch_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live folders of the zone by day: what a scan of a range of days lists."""
    manifest = land_epochs(spark, numbered(spark, sf_dir)[1], scratch_path(spark, "zone"))
    number = F.regexp_extract("folder", r"batch_id=(\d+)", 1).cast("int")
    days = manifest.entries().where(F.col("day").between(dt.date(2024, 1, 5), dt.date(2024, 1, 25)))
    return days.select(number.alias("epoch"), "day", "folder_rows")


@query(f"""
WITH {NUMBERED_SQL}
SELECT part AS kafka_partition, place AS kafka_offset, CAST(user_id AS VARCHAR) AS user_id, event_type,
       CASE WHEN ts + to_seconds(CAST(floor(value) AS BIGINT)) >= TIMESTAMP '2024-01-12 00:00:00'
             AND ts + to_seconds(CAST(floor(value) AS BIGINT)) < TIMESTAMP '2024-01-18 00:00:00'
            THEN 0.0 ELSE value END AS amount
FROM numbered
""")
def replay_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each offset once, after a skipping replay, a replacing one (whose amounts are zero) run twice, and a merge."""
    plain, dealt = numbered(spark, sf_dir)
    manifest = land_epochs(spark, dealt, scratch_path(spark, "zone"))
    replay_once(replay.by_time(plain, "2024-01-08", "2024-01-20", "timestamp"), EVENTS, manifest, SCHEMA, lineage=True)
    zeroed = F.regexp_replace(F.col("value").cast("string"), r'"amount":[0-9.Ee+-]+', '"amount":0.0').cast("binary")
    some = replay.by_time(plain, "2024-01-12", "2024-01-18", "timestamp").withColumn("value", zeroed)
    for _ in range(2):
        replay_once(some, EVENTS, manifest, SCHEMA, replace=True, lineage=True)
    manifest.merge(SCHEMA)
    return manifest.scan(SCHEMA).select("kafka_partition", "kafka_offset", "user_id", "event_type", "amount")


@query(f"""
WITH {NUMBERED_SQL},
landed AS (SELECT part, place, lag(place) OVER (PARTITION BY part ORDER BY place) AS before FROM numbered WHERE event_type <> 'click')
SELECT part AS partition, before + 1 AS first_lost, place - 1 AS last_lost FROM landed WHERE place > before + 1
""")
def lost_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps in the offsets, each noted by the epoch that came after it, where the feed lost its clicks."""
    dealt = numbered(spark, sf_dir)[1]
    kept = dealt.where(F.get_json_object(F.col("value").cast("string"), "$.event_type") != "click")
    lost = land_epochs(spark, kept, scratch_path(spark, "zone")).lost()
    return lost.select("partition", F.col("first").alias("first_lost"), F.col("last").alias("last_lost"))


VERSIONS = [
    "code int, total long",
    "code string, total decimal(20,2)",
    "code string, total decimal(20,2), note string",
]


@query(f"""
WITH {NUMBERED_SQL}
SELECT part AS kafka_partition, place AS kafka_offset, CAST(event_id % 1000 AS VARCHAR) AS code,
       CAST(CASE WHEN epoch = 0 THEN event_id * 100 ELSE event_id + 0.25 END AS DECIMAL(20,2)) AS total,
       CASE WHEN epoch = 2 THEN event_type END AS note
FROM numbered
""")
def evolve_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone of three versions, int to string and long to decimal among them, after its rewrite."""
    zone = scratch_path(spark, "versions")
    manifest = Manifest(spark, zone)
    rows = to_raw(numbered(spark, sf_dir)[1], EVENTS, lineage=True)
    event = F.col("kafka_offset") * 3 + F.col("kafka_partition")
    top = rows.agg(F.max(event) + 1)
    rows = rows.withColumns({"epoch": F.floor(event * EPOCHS / top.scalar()), "event": event})
    sums = F.when(F.col("epoch") == 0, F.col("event") * 100).otherwise(F.col("event") + F.lit(0.25).cast("decimal(3,2)"))
    values = rows.withColumns({"code": F.col("event") % 1000, "total": sums, "note": F.col("event_type")})
    for epoch, version in enumerate(VERSIONS):
        fields = T.StructType.fromDDL(version).fields
        kept = [*LINEAGE_FIELDS, *SCHEMA.fields[-2:]]
        part = values.where(F.col("epoch") == epoch).select(*[F.col(f.name).cast(f.dataType) for f in fields], *[f.name for f in kept])
        folder = f"generation=query/batch_id={epoch}"
        write_batch(part, f"{zone}/{folder}")
        manifest.add(folder, T.StructType([*fields, *kept]))
    newest = T.StructType([*T.StructType.fromDDL(VERSIONS[-1]).fields, *LINEAGE_FIELDS, *SCHEMA.fields[-2:]])
    manifest.rewrite(newest)
    return manifest.scan(newest).select("kafka_partition", "kafka_offset", "code", "total", "note")
