"""Parsing, landing, evolution and replay of the change feed."""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import id_prefix, key_id, key_op, padded_id, title_name
from tidemark.functions.parse import CORRUPT, LINEAGE_FIELDS, decode
from tidemark.operators import conform as cf
from tidemark.operators import evolution, replay, rollup
from tidemark.operators.ingest import batch_metrics, to_raw
from tidemark.operators.publish import iso_text, stamp_events, to_records
from tidemark.plans.feeds import (
    EVENTS,
    ORDERS,
    ORDERS_V2,
    order_variant_records,
    records,
    table,
)
from tidemark.plans.registry import FEED_SQL, query
from tidemark.session import scratch_path
from tidemark.sources import kafka
from tidemark.sources.files import raw_schema, scan_raw
from tidemark.streaming.sinks import compact, land_batch, register_table


@query(f"""
WITH {FEED_SQL}
SELECT user_id, event_type, amount, props, change_ts, op, partition_date FROM parsed
""")
def ingest_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_raw(records(spark, sf_dir, dirty=True), EVENTS)


@query("""
SELECT CASE o_orderstatus WHEN 'O' THEN 'I' WHEN 'P' THEN 'D' ELSE 'U' END AS op,
       CAST(o_orderkey AS VARCHAR) AS order_id,
       CASE WHEN o_orderstatus = 'O' THEN 'CUST' || CASE WHEN o_custkey < 1000
            THEN lpad(CAST(o_custkey AS VARCHAR), 4, '0') ELSE CAST(o_custkey AS VARCHAR) END END AS customer_id,
       CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS order_date,
       CASE o_orderstatus WHEN 'O' THEN 'Placed' WHEN 'F' THEN 'Delivered' END AS order_status,
       CASE WHEN o_orderstatus = 'O' THEN substr(o_orderpriority, 3, 20) END AS payment_type,
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS total_amount,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS change_ts,
       CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderdate AS DATE) END AS order_date_parsed,
       CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderdate AS DATE) ELSE DATE '1900-01-01' END AS partition_date
FROM orders
""")
def ingest_orders_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_raw(order_variant_records(spark, sf_dir), ORDERS_V2).drop("ingestion_ts")


@query(f"""
WITH {FEED_SQL}
SELECT user_id, event_type, op, CASE WHEN change_ts IS NOT NULL THEN CAST(ts AS DATE) END AS change_day, true AS stamped
FROM parsed
""")
def compact_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived columns of the raw zone are still there after it is compacted."""
    root = scratch_path(spark, "compact")
    spec = dataclasses.replace(EVENTS, parsed_date="change_day", stamp="ingested_at")
    land_batch(records(spark, sf_dir, dirty=True), spec, f"{root}/raw")
    compact(scan_raw(spark, f"{root}/raw", raw_schema(spec)), f"{root}/compacted")
    rows = scan_raw(spark, f"{root}/compacted", raw_schema(spec))
    return rows.select("user_id", "event_type", "op", "change_day", F.col("ingested_at").isNotNull().alias("stamped"))


@query(f"""
WITH {FEED_SQL}
SELECT partition_date, op, count(*) AS events FROM parsed
WHERE partition_date >= DATE '2024-01-05' AND op IN ('I', 'U') GROUP BY partition_date, op
""")
def ingest_partition_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the feed, scan it back pruned by date and op, count per partition."""
    path = scratch_path(spark, "raw")
    land_batch(records(spark, sf_dir, dirty=True), EVENTS, path)
    raw = scan_raw(spark, path, raw_schema(EVENTS), first=dt.date(2024, 1, 5), ops=["I", "U"])
    return rollup.change_profile(raw)


@query(f"""
WITH {FEED_SQL}
SELECT partition_date, op, count(*) AS events FROM parsed GROUP BY partition_date, op
""")
def change_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.change_profile(to_raw(records(spark, sf_dir, dirty=True), EVENTS))


@query(f"""
WITH {FEED_SQL}
SELECT count(*) AS rows, count(*) FILTER (WHERE partition_date = DATE '1900-01-01') AS fallback_rows,
       count(corrupt) AS malformed_rows,
       min(CAST(change_ts AS TIMESTAMP)) AS min_change_ts, max(CAST(change_ts AS TIMESTAMP)) AS max_change_ts
FROM parsed
""")
def batch_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = to_raw(records(spark, sf_dir, dirty=True), EVENTS, corrupt=True)
    return rows.agg(*batch_metrics(rows)).select(
        "rows",
        "fallback_rows",
        "malformed_rows",
        F.timestamp_micros("min_change_us").cast("timestamp_ntz").alias("min_change_ts"),
        F.timestamp_micros("max_change_us").cast("timestamp_ntz").alias("max_change_ts"),
    )


@query(f"""
WITH {FEED_SQL}
SELECT event_id AS kafka_offset, CAST(event_id % 3 AS INTEGER) AS kafka_partition, corrupt AS message
FROM parsed WHERE corrupt IS NOT NULL
""")
def parse_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decode(records(spark, sf_dir, dirty=True), EVENTS.schema, lineage=True, corrupt=True)
    return rows.filter(F.col(CORRUPT).isNotNull()).select(
        "kafka_offset", "kafka_partition", F.col(CORRUPT).alias("message")
    )


@query(f"""
WITH {FEED_SQL}
SELECT event_id AS kafka_offset, ts + to_seconds(CAST(floor(amount) AS BIGINT)) AS kafka_timestamp,
       op || '_' || user_id AS kafka_key, op AS key_op, user_id AS key_id
FROM feed
""")
def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker coordinates kept beside the data, and the parts of the message key."""
    rows = decode(records(spark, sf_dir), EVENTS.schema, lineage=True)
    return rows.select(
        "kafka_offset",
        F.col("kafka_timestamp").cast("timestamp_ntz").alias("kafka_timestamp"),
        "kafka_key",
        key_op(F.col("kafka_key")).alias("key_op"),
        key_id(F.col("kafka_key")).alias("key_id"),
    )


@query("""
SELECT event_id AS kafka_offset, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")
def parse_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON inside a JSON field."""
    rows = decode(records(spark, sf_dir), EVENTS.schema, lineage=True)
    return rows.select("kafka_offset", F.from_json("props", "k int")["k"].alias("k"))


@query("""
WITH canonical AS (
  SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, o_orderpriority, o_orderstatus, 'orders_v2' AS feed,
         CASE o_orderstatus WHEN 'O' THEN 'I' WHEN 'P' THEN 'D' ELSE 'U' END AS op,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS change_ts,
         o_orderstatus = 'O' AS whole, o_orderstatus <> 'P' AS alive
  FROM orders
)
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
       CASE WHEN whole THEN 'CUST' || CASE WHEN o_custkey < 10000
            THEN lpad(CAST(o_custkey AS VARCHAR), 5, '0') ELSE CAST(o_custkey AS VARCHAR) END END AS customer_id,
       CASE WHEN whole THEN change_ts END AS order_date, CASE WHEN alive THEN o_totalprice END AS order_amount,
       CAST(NULL AS VARCHAR) AS currency,
       CASE WHEN whole THEN upper(substr(o_orderpriority, 3, 20)) END AS payment_type,
       CASE o_orderstatus WHEN 'O' THEN 'PLACED' WHEN 'F' THEN 'DELIVERED' END AS status, change_ts, op, feed
FROM canonical
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), 'CUST' || CASE WHEN o_custkey < 10000
            THEN lpad(CAST(o_custkey AS VARCHAR), 5, '0') ELSE CAST(o_custkey AS VARCHAR) END,
       strftime(o_orderdate, '%Y-%m-%d'), o_totalprice, 'INR', 'CARD', 'SHIPPED',
       strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S.%f'), 'U', 'orders'
FROM orders
""")
def conform_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second shape of orders brought to the first, and both in one table."""
    second = decode(order_variant_records(spark, sf_dir), ORDERS_V2.schema)
    day = F.col("o_orderdate").cast("timestamp")
    first = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        padded_id("CUST", F.col("o_custkey"), 5).alias("customer_id"),
        F.date_format(day, "yyyy-MM-dd").alias("order_date"),
        F.col("o_totalprice").alias("order_amount"),
        F.lit("INR").alias("currency"),
        F.lit("CARD").alias("payment_type"),
        F.lit("SHIPPED").alias("status"),
        iso_text(F.expr("cast(o_orderdate as timestamp) + interval 1 day")).alias("change_ts"),
        F.lit("U").alias("op"),
    )
    return cf.union_feeds(
        [
            cf.conform(second, ORDERS_V2, ORDERS).withColumn("feed", F.lit("orders_v2")),
            first.withColumn("feed", F.lit("orders")),
        ]
    )


@query(f"""
WITH {FEED_SQL}
SELECT 'coupon' AS field, count(*) AS messages FROM parsed WHERE extended
""")
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evolution.unknown_keys(records(spark, sf_dir, dirty=True), EVENTS.columns)


@query(f"""
WITH {FEED_SQL}
SELECT event_id AS kafka_offset, CASE WHEN extended THEN 'yes' END AS coupon FROM parsed WHERE corrupt IS NULL
""")
def extra_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown fields survive in a map beside the typed columns."""
    rows = decode(
        records(spark, sf_dir, dirty=True), EVENTS.schema, lineage=True, corrupt=True, extra=True
    )
    return rows.filter(F.col(CORRUPT).isNull()).select("kafka_offset", F.col("_extra")["coupon"].alias("coupon"))


@query("""
SELECT event_id, event_type, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN value END AS value
FROM events
""")
def evolve_add_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files written before a column existed read as null."""
    events, path = table(spark, sf_dir, "events"), scratch_path(spark, "added")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    events.filter(F.col("ts") < cut).select("event_id", "event_type").write.parquet(f"{path}/v=1")
    events.filter(F.col("ts") >= cut).select("event_id", "event_type", "value").write.parquet(f"{path}/v=2")
    newest = T.StructType.fromDDL("event_id bigint, event_type string, value double")
    return evolution.read_evolved(spark, [f"{path}/v=1", f"{path}/v=2"], newest)


@query("""
SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size FROM part
UNION ALL SELECT p_partkey, p_size + 4000000000 FROM part
""")
def evolve_widen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old files hold int, new files bigint."""
    part, path = table(spark, sf_dir, "part"), scratch_path(spark, "widened")
    old = part.select("p_partkey", F.col("p_size").cast("int").alias("p_size"))
    new = part.select("p_partkey", (F.col("p_size").cast("bigint") + F.lit(4000000000)).alias("p_size"))
    old.write.parquet(f"{path}/v=1")
    new.write.parquet(f"{path}/v=2")
    newest = T.StructType.fromDDL("p_partkey bigint, p_size bigint")
    evolution.check_widening(old.schema, newest)
    return evolution.read_evolved(spark, [f"{path}/v=1", f"{path}/v=2"], newest)


def _landed_with_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lineage")
    land_batch(records(spark, sf_dir), EVENTS, path, lineage=True)
    return scan_raw(spark, path, raw_schema(EVENTS, LINEAGE_FIELDS))


@query("""
SELECT event_id AS kafka_offset, CAST(event_id % 3 AS INTEGER) AS kafka_partition,
       CAST(user_id AS VARCHAR) AS user_id, event_type, value AS amount
FROM events
WHERE event_id >= CASE event_id % 3 WHEN 0 THEN 300 WHEN 1 THEN 0 ELSE 100 END
""")
def replay_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read the landed feed again from a given offset of each partition to its end."""
    end = 2**62
    ranges = {0: (300, end), 1: (0, end), 2: (100, end)}
    rows = replay.by_offset(_landed_with_lineage(spark, sf_dir), ranges)
    return rows.select("kafka_offset", "kafka_partition", "user_id", "event_type", "amount")


@query("""
SELECT event_id AS kafka_offset, CAST(user_id AS VARCHAR) AS user_id, event_type, value AS amount
FROM events
WHERE ts + to_seconds(CAST(floor(value) AS BIGINT)) >= TIMESTAMP '2024-01-10 00:00:00'
  AND ts + to_seconds(CAST(floor(value) AS BIGINT)) < TIMESTAMP '2024-01-20 12:00:00'
""")
def replay_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read the landed feed again by broker time."""
    rows = replay.by_time(_landed_with_lineage(spark, sf_dir), "2024-01-10 00:00:00", "2024-01-20 12:00:00")
    return rows.select("kafka_offset", "user_id", "event_type", "amount")


@query("""
SELECT 'U_' || CAST(c_custkey AS VARCHAR) AS key,
       '{"customer_id":' || CAST(c_custkey AS VARCHAR) || ',"name":"' || c_name || '","segment":"'
         || c_mktsegment || '","change_ts":"2024-02-01T00:00:00.000000","op":"U"}' AS value,
       'customers_cdc' AS topic,
       CAST(CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 3 AS INTEGER) AS partition
FROM customer
""")
def publish_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a table as keyed change messages."""
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    events = stamp_events(rows, F.lit("U"), F.lit("2024-02-01T00:00:00.000000"))
    return to_records(events, ["customer_id"], "customers_cdc")


@query(f"""
WITH {FEED_SQL}
SELECT partition_date, event_type, count(*) AS events, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS amount
FROM parsed WHERE op = 'U' GROUP BY partition_date, event_type
""")
def curated_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch ingestion into an external table, queried by SQL."""
    path = scratch_path(spark, "curated")
    land_batch(records(spark, sf_dir, dirty=True), EVENTS, path)
    name = "curated_" + path.rsplit("-", 1)[1]
    register_table(spark, name, raw_schema(EVENTS), path)
    return spark.sql(
        f"SELECT partition_date, event_type, count(*) AS events, sum(cast(amount AS decimal(18,2))) AS amount "
        f"FROM {name} WHERE op = 'U' GROUP BY partition_date, event_type"
    )


@query("""
SELECT event_id % 3 AS partition, min(event_id) AS first_offset, max(event_id) AS last_offset,
       count(*) AS landed, max(event_id) - min(event_id) + 1 - count(*) AS lost
FROM events WHERE event_type <> 'click' GROUP BY event_id % 3
""")
def lost_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets missing between those landed; the feed without its clicks, twice delivered."""
    events = table(spark, sf_dir, "events").filter(F.col("event_type") != "click")
    landed = events.select(
        F.lit("events_cdc").alias("topic"),
        F.pmod("event_id", F.lit(3)).alias("partition"),
        F.col("event_id").alias("offset"),
    )
    return kafka.lost_offsets(landed.unionByName(landed)).drop("topic")


@query("""
SELECT o_orderkey AS order_id, upper(substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 10)) AS shipment_id,
       'Order ' || CAST(o_orderkey AS VARCHAR) AS title,
       CAST(o_orderdate AS DATE) + CAST(1 + o_orderkey % 7 AS INTEGER) AS expected_delivery
FROM orders
""")
def shipment_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived columns of a shipment: short id, title, and delivery one to seven days after the order."""
    orders = table(spark, sf_dir, "orders")
    days = (F.lit(1) + F.pmod("o_orderkey", F.lit(7))).cast("int")
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        id_prefix(F.md5(F.col("o_orderkey").cast("string")), 10).alias("shipment_id"),
        title_name("order", F.col("o_orderkey")).alias("title"),
        F.date_add(F.col("o_orderdate").cast("date"), days).alias("expected_delivery"),
    )
