"""Command line jobs.

    spark-submit -m tidemark.jobs ingest --root hdfs:///lake --tables orders customers
    spark-submit -m tidemark.jobs check --root hdfs:///lake --tables orders --first 2025-01-01
    spark-submit -m tidemark.jobs compact --root hdfs:///lake --tables orders --last 2025-01-31
    spark-submit -m tidemark.jobs register --root hdfs:///lake --tables orders
    spark-submit -m tidemark.jobs curate --root hdfs:///lake --tables orders
    spark-submit -m tidemark.jobs publish --root hdfs:///lake --tables orders --servers broker:9092
    spark-submit -m tidemark.jobs replay --root hdfs:///lake --tables orders --since 2025-01-01 --until 2025-01-02
    spark-submit -m tidemark.jobs merge --root hdfs:///lake --tables orders --last 2025-01-31
    spark-submit -m tidemark.jobs evolve --root hdfs:///lake --tables orders
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.parse import CORRUPT, LINEAGE_FIELDS, instant
from tidemark.operators import conform, dedup, fold, history, quality, replay
from tidemark.operators.fold import DELETE, FULL
from tidemark.operators.publish import Published, publish
from tidemark.session import build_session, scratch_path
from tidemark.sources import kafka
from tidemark.sources.files import raw_schema, read_records, scan_raw, stream_records
from tidemark.spec import CONFIG_DIR, TableSpec, load_specs
from tidemark.streaming.ingest import ingest_tables
from tidemark.streaming.manifest import Manifest, replay_once
from tidemark.streaming.sinks import (
    compact,
    folders,
    register_table,
    remove,
    replace_days,
    replace_table,
)


log = logging.getLogger("tidemark")


def landed_schema(spec: TableSpec) -> T.StructType:
    return raw_schema(spec, [T.StructField(CORRUPT, T.StringType()), *LINEAGE_FIELDS])


def trusted_schema(spec: TableSpec) -> T.StructType:
    data = [f for f in landed_schema(spec).fields if f.name != "partition_date"]
    failed = T.StructField(quality.FAILED, T.ArrayType(T.StringType()))
    return T.StructType([*data, failed, T.StructField("partition_date", T.DateType())])


def landed(
    spark: SparkSession, spec: TableSpec, root: str, first=None, last=None, zone: str = "raw"
) -> DataFrame:
    """A table as ``ingest`` writes it, or ``compact`` rewrites it; of a zone with a manifest its live folders."""
    if zone == "raw":
        manifest = Manifest(spark, f"{root}/raw/{spec.table}")
        if manifest.exists():
            return manifest.scan(landed_schema(spec), first, last)
    return scan_raw(spark, f"{root}/{zone}/{spec.table}", landed_schema(spec), first, last)


def living(spark: SparkSession, spec: TableSpec, args) -> DataFrame:
    """Keys of a parent table that are not deleted, from its trusted zone or, unchecked, from ``--zone``.

    A table that was never landed has no keys, so every reference to it dangles.
    """
    keys = list(spec.primary_key)
    zones = [z for z in ("trusted", args.zone) if folders(spark, f"{args.root}/{z}/{spec.table}")]
    if not zones:
        log.warning("parent table %s is not landed: treated as empty", spec.table)
        return spark.createDataFrame([], T.StructType([f for f in spec.schema.fields if f.name in keys]))
    events = landed(spark, spec, args.root, zone=zones[0])
    usable = reduce(and_, [F.col(k).isNotNull() for k in keys])
    at = F.struct(instant(spec.event_time).alias("at"), "kafka_partition", "kafka_offset")
    last = events.filter(usable).groupBy(*keys).agg(F.max_by("op", at).alias("op"))
    return last.filter(~F.col("op").eqNullSafe(DELETE)).select(*keys)


def ingest(spark: SparkSession, specs: list[TableSpec], args) -> None:
    def source(spec: TableSpec) -> DataFrame:
        if args.files:
            return stream_records(spark, f"{args.files}/{spec.topic}")
        return kafka.read_stream(
            spark, spec, servers=args.servers, max_offsets=args.max_offsets, pattern=spec.topic_pattern or None
        )

    trigger = {"availableNow": True} if args.once else {"processingTime": args.every}
    queries = ingest_tables(spark, specs, source, args.root, trigger, lineage=True, corrupt=True, drift=True)
    if args.once:
        for q in queries:
            q.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


def check(spark: SparkSession, specs: list[TableSpec], args) -> None:
    """Raw to trusted and quarantine, with a scorecard; abort above the allowed share."""
    by_name = load_specs(args.config)
    for spec in specs:
        needed = {r["parent"] for r in spec.rules if r["type"] == "referential"}
        parents = {p: living(spark, by_name[p], args) for p in sorted(needed)}
        raw = landed(spark, spec, args.root, args.first, args.last, args.zone)
        # Rules across rows shuffle the table; what they find is kept for the readers below.
        staged = scratch_path(spark, f"checked-{spec.table}")
        try:
            found = quality.evaluate(raw, list(spec.rules), parents)
            found.write.partitionBy(quality.REJECTED).parquet(staged)
            publish_checked(spark.read.schema(found.schema).parquet(staged), spec, args)
        finally:
            remove(spark, staged)


def publish_checked(checked: DataFrame, spec: TableSpec, args) -> None:
    totals = checked.groupBy(quality.REJECTED).count().collect()  # two rows
    counts = {r[quality.REJECTED]: r["count"] for r in totals}
    limit = spec.max_share if args.max_share is None else args.max_share
    quality.enforce(sum(counts.values()), counts.get(True, 0), limit)
    replace_days(quality.trusted(checked), f"{args.root}/trusted/{spec.table}", args.first, args.last)
    replace_days(quality.quarantined(checked), f"{args.root}/quarantine/{spec.table}", args.first, args.last)
    card = quality.scorecard(checked, list(spec.rules))
    days = f"first={args.first or 'begin'}/last={args.last or 'end'}"  # a card for each range that was checked
    card.coalesce(1).write.mode("overwrite").parquet(f"{args.root}/scorecards/{spec.table}/{days}")


def compact_raw(spark: SparkSession, specs: list[TableSpec], args) -> None:
    for spec in specs:
        rows = landed(spark, spec, args.root, args.first, args.last)
        compact(rows, f"{args.root}/compacted/{spec.table}")


def register(spark: SparkSession, specs: list[TableSpec], args) -> None:
    """Trusted zones as external tables; run again to pick up new days."""
    for spec in specs:
        path = f"{args.root}/trusted/{spec.table}"
        register_table(spark, f"trusted_{spec.table}", trusted_schema(spec), path, ["partition_date"])


def trusted_events(spark: SparkSession, canonical: TableSpec, args) -> tuple[DataFrame | None, set[str]]:
    """Trusted rows of every feed of a table in its own columns, each event once, and the modes of the feeds."""
    feeds = [s for s in load_specs(args.config).values() if (s.feeds or s.table) == canonical.table]
    feeds = [s for s in feeds if folders(spark, f"{args.root}/trusted/{s.table}")]
    if not feeds:
        return None, set()
    place = ["kafka_partition", "kafka_offset"]
    rows = []
    for feed in feeds:
        landed_rows = landed(spark, feed, args.root, zone="trusted").select(*feed.columns, *place)
        mode = {FULL: F.lit(feed.mode == "full"), "feed": F.lit(feed.table)}
        rows.append(conform.conform(landed_rows, feed, canonical).select(*canonical.columns, *place).withColumns(mode))
    events = conform.union_feeds(rows)
    keys = [*canonical.primary_key, "feed"]  # the same change may come as a row and as a patch
    once = dedup.drop_redelivered(events, keys, place, canonical.event_time)
    return once.withColumn("change_at", instant(canonical.event_time)), {f.mode for f in feeds}


def next_run(spark: SparkSession, path: str) -> str:
    """A folder for new files; of the earlier ones only the last stays, for those who still read it."""
    runs = sorted(int(n.split("=")[1]) for n in folders(spark, path) if n.startswith("run="))
    for old in runs[:-1]:
        remove(spark, f"{path}/run={old}")
    return f"{path}/run={runs[-1] + 1 if runs else 0}"


def curate(spark: SparkSession, specs: list[TableSpec], args) -> None:
    """Trusted events of all feeds of a table to its current rows and its history, as SQL tables."""
    order = ["change_at", "kafka_partition", "kafka_offset", "feed"]
    for spec in specs:
        if (spec.feeds or spec.table) != spec.table:
            continue  # a variant is folded with the table that it feeds
        events, modes = trusted_events(spark, spec, args)
        if events is None:
            log.warning("no trusted rows of %s", spec.table)
            continue
        keys = list(spec.primary_key)
        events = events.drop(spec.event_time)
        if modes == {"full"}:
            events = events.drop(FULL)
            tables = {"current": fold.latest_rows(events, keys, order), "history": history.versions(events, keys, order)}
        else:
            tables = {
                "current": fold.fold_patches(events, keys, order, spec.payload, keep=["change_at"]),
                "history": history.folded_versions(events, keys, order, spec.payload),
            }
        for kind, rows in tables.items():
            path = next_run(spark, f"{args.root}/curated/{kind}_{spec.table}")
            rows.write.parquet(path)
            replace_table(spark, f"{kind}_{spec.table}", rows.schema, path)


def publish_current(spark: SparkSession, specs: list[TableSpec], args) -> None:
    """Keys of the current rows that changed since the last run, to Kafka or below ``--out``; deleted ones too."""
    for spec in specs:
        rows = spark.table(f"current_{spec.table}")
        rows = rows.select(*spec.primary_key, *[c for c in spec.payload if c in rows.columns])
        at = F.lit(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(timespec="microseconds"))

        def send(records: DataFrame, run: int, topic: str = spec.topic) -> None:
            path = f"{args.out}/{topic}/run={run}" if args.out else None
            publish(records, None if path else args.servers, path)

        state = Published(spark, f"{args.root}/published/{spec.table}")
        state.run(rows, list(spec.primary_key), spec.topic, at, send, args.patches)


def replay_range(spark: SparkSession, specs: list[TableSpec], args) -> None:
    """Records between two broker times, read again as a table: what is landed already is skipped or replaced."""
    for spec in specs:
        if args.files:
            records = replay.by_time(read_records(spark, f"{args.files}/{spec.topic}"), args.since, args.until, "timestamp")
        else:
            bounds = [int(dt.datetime.fromisoformat(t).replace(tzinfo=dt.timezone.utc).timestamp() * 1000) for t in (args.since, args.until)]
            records = kafka.read_range(spark, kafka.time_range_options(spec.topic, args.servers, *bounds))
        manifest = Manifest(spark, f"{args.root}/raw/{spec.table}")
        if not manifest.exists():
            manifest.adopt()
        folder = replay_once(records, spec, manifest, landed_schema(spec), args.replace, lineage=True, corrupt=True)
        log.info("[%s] replay: %s", spec.table, folder or "nothing new")


def merge_raw(spark: SparkSession, specs: list[TableSpec], args) -> None:
    """Days of the raw zone that lie in many epochs, rewritten into one folder each; what that covers goes."""
    for spec in specs:
        manifest = Manifest(spark, f"{args.root}/raw/{spec.table}")
        if not manifest.exists():
            manifest.adopt()
        folder = manifest.merge(landed_schema(spec), args.first, args.last)
        log.info("[%s] merged into %s", spec.table, folder or "nothing")


def evolve(spark: SparkSession, specs: list[TableSpec], args) -> None:
    """Epochs written under a schema whose types Parquet cannot widen to today's, rewritten under it."""
    for spec in specs:
        folder = Manifest(spark, f"{args.root}/raw/{spec.table}").rewrite(landed_schema(spec))
        log.info("[%s] rewritten into %s", spec.table, folder or "nothing")


JOBS = {
    "ingest": ingest,
    "replay": replay_range,
    "check": check,
    "compact": compact_raw,
    "merge": merge_raw,
    "evolve": evolve,
    "register": register,
    "curate": curate,
    "publish": publish_current,
}


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--root", required=True, help="folder of all zones")
    parser.add_argument("--tables", nargs="*", help="default: every configured table")
    parser.add_argument("--config", default=str(CONFIG_DIR), help="folder of table configs")
    parser.add_argument("--servers", default=kafka.DEFAULT_SERVERS)
    parser.add_argument("--files", help="read topics kept as Parquet below this folder instead of Kafka")
    parser.add_argument("--max-offsets", type=int, help="records per batch")
    parser.add_argument("--every", default="10 seconds", help="trigger interval")
    parser.add_argument("--once", action="store_true", help="take what is available and stop")
    parser.add_argument("--first", type=dt.date.fromisoformat)
    parser.add_argument("--last", type=dt.date.fromisoformat)
    parser.add_argument("--zone", default="raw", choices=["raw", "compacted"], help="what check reads")
    parser.add_argument("--since", help="replay: first broker time, UTC")
    parser.add_argument("--until", help="replay: broker time after the last one, UTC")
    parser.add_argument("--replace", action="store_true", help="replay: put the records in place of those landed before")
    parser.add_argument("--patches", action="store_true", help="publish: send of a changed row only the columns that changed")
    parser.add_argument("--out", help="publish as Parquet below this folder instead of Kafka")
    parser.add_argument("--width", type=int, default=4096, help="shuffle partitions before small ones are joined")
    parser.add_argument("--max-share", type=float, help="abort if more rows are rejected; default by table config")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    args = parse(argv)
    specs = load_specs(args.config)
    wanted = args.tables or list(specs)
    unknown = set(wanted) - set(specs)
    if unknown:
        raise SystemExit(f"no config for {', '.join(sorted(unknown))}")
    if spark is None:
        # AQE joins small partitions but cannot split those of windows and aggregates: begin with many
        width = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(args.width)}
        spark = build_session(f"tidemark-{args.job}", **width)
    JOBS[args.job](spark, [specs[t] for t in wanted], args)


if __name__ == "__main__":
    main()
