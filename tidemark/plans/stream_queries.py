"""The same feed as a stream; each query runs what is available and reads the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.fold import fold_result, latest_rows
from tidemark.operators.joins import with_parent
from tidemark.operators.skew import profile
from tidemark.plans.feeds import COLUMNS, EVENTS, ORDER, as_records, event_op, plain_time, Retail, table
from tidemark.plans.registry import FEED_SQL, query
from tidemark.plans.state_queries import PATCH_STATE_SQL
from tidemark.session import scratch_path, settings, state_partitions, use_utc
from tidemark.sources.files import raw_schema, scan_raw, stream_table
from tidemark.streaming import operators as ops
from tidemark.streaming.ingest import start_ingest
from tidemark.streaming.sinks import latest_run
from tidemark.streaming.metrics import BatchMetrics, read_drift, read_metrics, settle
from tidemark.streaming.state import compact_state, read_state, state_writer
from tidemark.streaming.stateful import STATE_STORE, live_state

ONCE = {"availableNow": True}


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables as a stream of its files."""
    return stream_table(use_utc(spark), f"{sf_dir}/{name}.parquet", COLUMNS[name])


def _timed(events: DataFrame) -> DataFrame:
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def _finish(stream: DataFrame, name: str) -> DataFrame:
    """Run an append query to the end of its input; its rows as a table."""
    spark = stream.sparkSession
    root = scratch_path(spark, name)
    with settings(spark, state_partitions(spark)):
        run = (
            stream.writeStream.format("parquet")
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(**ONCE)
            .start(f"{root}/out")
        )
        run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


@query(f"""
WITH {FEED_SQL}
SELECT user_id, event_type, amount, props, change_ts, op, partition_date FROM parsed
""")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw zone filled by the streaming job."""
    root = scratch_path(spark, "stream-ingest")
    feed = as_records(_stream(spark, sf_dir, "events"), dirty=True)
    start_ingest(feed, EVENTS, f"{root}/raw", f"{root}/checkpoint", ONCE).awaitTermination()
    return scan_raw(spark, f"{root}/raw", raw_schema(EVENTS))


@query(f"""
WITH {FEED_SQL}
SELECT 'events' AS "table", count(*) AS rows, count(*) FILTER (WHERE partition_date = DATE '1900-01-01') AS fallback_rows,
       count(corrupt) AS malformed_rows, min(CAST(change_ts AS TIMESTAMP)) AS min_change_ts,
       max(CAST(change_ts AS TIMESTAMP)) AS max_change_ts, count(*) AS input_rows
FROM parsed
""")
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures observed while the stream was landed, without another pass."""
    root = scratch_path(spark, "stream-metrics")
    feed = as_records(_stream(spark, sf_dir, "events"), dirty=True)
    spark.streams.addListener(BatchMetrics(spark, EVENTS.table, f"{root}/metrics"))
    start_ingest(feed, EVENTS, f"{root}/raw", f"{root}/checkpoint", ONCE, corrupt=True).awaitTermination()
    settle(spark)
    return read_metrics(spark, f"{root}/metrics").groupBy("table").agg(
        F.sum("rows").alias("rows"),
        F.sum("fallback_rows").alias("fallback_rows"),
        F.sum("malformed_rows").alias("malformed_rows"),
        F.timestamp_micros(F.min("min_change_us")).cast("timestamp_ntz").alias("min_change_ts"),
        F.timestamp_micros(F.max("max_change_us")).cast("timestamp_ntz").alias("max_change_ts"),
        F.sum("input_rows").alias("input_rows"),
    )


@query(f"""
WITH {FEED_SQL}
SELECT 'events' AS "table", 'coupon' AS field, count(*) AS messages FROM parsed WHERE extended
""")
def stream_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown fields noted while the stream was landed, in the same action."""
    root = scratch_path(spark, "stream-drift")
    feed = as_records(_stream(spark, sf_dir, "events"), dirty=True)
    spark.streams.addListener(BatchMetrics(spark, EVENTS.table, f"{root}/metrics"))
    start_ingest(feed, EVENTS, f"{root}/raw", f"{root}/checkpoint", ONCE, drift=True).awaitTermination()
    settle(spark)
    return read_drift(spark, f"{root}/metrics")


@query("""
SELECT user_id, ts, event_type, value FROM events
""")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with all purchases delivered twice, deduplicated on the way."""
    events = _timed(_stream(spark, sf_dir, "events")).select("event_id", "user_id", "ts", "event_type", "value")
    again = events.filter(F.col("event_type") == "purchase").withColumn(
        "event_id", F.col("event_id") + F.lit(10**15)
    )
    keys = ["user_id", "ts", "event_type"]
    once = ops.drop_duplicates(events.unionByName(again), keys, "ts", "1 hour", spread_by=["event_id"])
    return _finish(once.drop("event_id"), "stream-dedup").withColumns(plain_time("ts"))


def _patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed whose updates carry an amount only with a purchase."""
    return _stream(spark, sf_dir, "events").select(
        "user_id",
        "event_type",
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("amount"),
        "props",
        event_op().alias("op"),
        F.col("ts").alias("change_at"),
        F.pmod(F.col("event_id"), F.lit(3)).cast("int").alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
    )


@query(PATCH_STATE_SQL)
def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state kept up to date batch by batch, then compacted."""
    root = scratch_path(spark, "stream-state")
    keys, columns = ["user_id"], ["event_type", "amount", "props"]
    events = _patches(spark, sf_dir)
    run = (
        events.writeStream.foreachBatch(state_writer(f"{root}/state", keys, ORDER, columns))
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(**ONCE)
        .start()
    )
    run.awaitTermination()
    compact_state(spark, f"{root}/state", keys)
    return fold_result(read_state(spark, f"{root}/state", keys), keys, columns, ["change_at"])


@query("""
SELECT event_id, ts, user_id, c_name AS name, n_name AS country
FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
""")
def stream_static_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events enriched with the customer on the way."""
    customers = Retail(spark, sf_dir).customers.select(
        F.col("customer_id").alias("user_id"), "name", "country"
    )
    events = _stream(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    return _finish(with_parent(events, customers, ["user_id"]), "stream-static")


@query("""
SELECT o_orderkey AS order_id, o_orderdate AS ordered, l_linenumber AS line, l_partkey AS product_id, l_shipdate AS shipped
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
 AND l_shipdate >= o_orderdate + INTERVAL 1 DAY AND l_shipdate <= o_orderdate + INTERVAL 90 DAY
""")
def stream_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the shipments that leave 1 to 90 days later.

    The tables are in no order of time, hence the long delay; hot orders are
    known from the landed shipments.
    """
    orders = _stream(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("timestamp").alias("ordered")
    )
    shipments = _stream(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_shipdate").cast("timestamp").alias("shipped"),
    )
    landed = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_id"))
    joined = ops.join_within(
        orders, shipments, "order_id", "ordered", "shipped", "4000 days", "1 day", "90 days",
        profile(landed, ["order_id"]),
    )
    return _finish(joined, "stream-join").withColumns(plain_time("ordered", "shipped"))


def _in_parts(spark: SparkSession, events: DataFrame, part, parts: int, name: str) -> DataFrame:
    """``events`` written part by part, as a stream of one part after the other."""
    path = scratch_path(spark, name)
    for n in range(parts):
        events.where(part == n).coalesce(1).write.mode("append").parquet(path)
    return stream_table(spark, path, events.schema, files_per_batch=1)


# Parts follow each other in time; one in fifty of the first comes with the last, too late.
PARTS_SQL = """
parts AS (SELECT *, event_id * 4 // (SELECT max(event_id) + 1 FROM events) AS part FROM events),
timely AS (SELECT * FROM parts WHERE NOT (part = 0 AND event_id % 50 = 7))
"""


def _late_parts(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    top = events.agg(F.max("event_id") + 1)
    part = F.floor(F.col("event_id") * 4 / top.scalar())
    late = (part == 0) & (F.col("event_id") % 50 == 7)
    dealt = events.withColumn("part", F.when(late, 3).otherwise(part)).where(F.col("event_type") == kind)
    dealt = dealt.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "part")
    return _in_parts(spark, dealt, F.col("part"), 4, f"{kind}-parts").drop("part")


@query(f"""
WITH {PARTS_SQL},
seen AS (SELECT event_id, user_id, ts FROM timely WHERE event_type = 'view'),
bought AS (SELECT event_id, user_id, ts FROM timely WHERE event_type = 'purchase'),
joined AS (
  SELECT s.event_id AS view_id, s.user_id, s.ts AS viewed, b.event_id AS purchase_id, b.ts AS bought
  FROM seen s LEFT JOIN bought b ON s.user_id = b.user_id AND b.ts >= s.ts AND b.ts <= s.ts + INTERVAL 2 DAY
)
SELECT * FROM joined
WHERE purchase_id IS NOT NULL OR viewed + INTERVAL 2 DAY
      < (SELECT least((SELECT max(ts) FROM seen), (SELECT max(ts) FROM bought)) - INTERVAL 1 DAY)
""")
def stream_outer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views with the purchases of the next two days, or none, once the watermark has passed; late rows are dropped."""
    seen = _late_parts(spark, sf_dir, "view").select(F.col("event_id").alias("view_id"), "user_id", F.col("ts").alias("viewed"))
    bought = _late_parts(spark, sf_dir, "purchase").select(F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("bought"))
    joined = ops.left_within(seen, bought, "user_id", "viewed", "bought", "1 day", "0 days", "2 days")
    return _finish(joined, "stream-outer").withColumns(plain_time("viewed", "bought"))


@query("""
SELECT event_id, user_id, CASE WHEN event_id * 2 < (SELECT max(event_id) + 1 FROM events) THEN c_name ELSE upper(c_name) || '!' END AS name
FROM events LEFT JOIN customer ON user_id = c_custkey
""")
def stream_refreshed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their customer as it stood when their batch began; the customers change between two batches."""
    root = scratch_path(spark, "stream-refreshed")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))
    customers.write.parquet(f"{root}/customers/run=0")
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    top = events.agg(F.max("event_id") + 1)
    half = F.floor(F.col("event_id") * 2 / top.scalar())
    stream = _in_parts(spark, events.withColumn("half", half), F.col("half"), 2, "halves").drop("half")

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch_id={epoch}")
        later = customers.withColumn("name", F.concat(F.upper("name"), F.lit("!")))
        later.write.mode("overwrite").parquet(f"{root}/customers/run={epoch + 1}")

    newest = lambda session: session.read.schema(customers.schema).parquet(latest_run(session, f"{root}/customers"))
    run = (
        stream.writeStream.foreachBatch(ops.with_current_parent(newest, ["user_id"], write))
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(**ONCE)
        .start()
    )
    run.awaitTermination()
    return spark.read.schema("event_id long, user_id long, name string").parquet(f"{root}/out").select("event_id", "user_id", "name")


@query("""
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       event_type, count(*) AS events
FROM events GROUP BY date_trunc('hour', ts), event_type
HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
""")
def stream_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour, for the hours the watermark has closed."""
    events = _timed(_stream(spark, sf_dir, "events"))
    closed = ops.rates(events, "ts", "1 hour", "1 hour", ["event_type"])
    return _finish(closed, "stream-rates").withColumns(plain_time("window_start", "window_end"))


@query(f"SELECT user_id, event_type, amount, props FROM ({PATCH_STATE_SQL})")
def stream_state_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state held in the state store; upserts are written and the last one per key read."""
    root = scratch_path(spark, "stream-store")
    keys, columns = ["user_id"], ["event_type", "amount", "props"]
    upserts = live_state(_patches(spark, sf_dir), keys, ORDER, columns)

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch_id={epoch}")

    with settings(spark, STATE_STORE | state_partitions(spark)):
        run = (
            upserts.writeStream.outputMode("update")
            .foreachBatch(write)
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(**ONCE)
            .start()
        )
        run.awaitTermination()
    schema = T.StructType([*upserts.schema.fields, T.StructField("batch_id", T.LongType())])
    written = spark.read.schema(schema).parquet(f"{root}/out")
    # a late event changes the row but not the position, hence the batch
    return latest_rows(written, keys, ["position", "batch_id"]).select("user_id", *columns)
