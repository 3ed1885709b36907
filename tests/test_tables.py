"""Sources, evolution, conforming, publishing and curated joins."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.parse import decode
from tidemark.operators import conform, enrich, evolution, joins, publish, replay
from tidemark.sources import kafka
from tidemark.sources.files import read_master, read_master_ids, read_records, scan_raw
from tidemark.spec import load_spec
from tidemark.streaming.sinks import compact, replace_partitions


def test_stream_of_a_topic_pattern():
    """One query for every feed of a table, from a point in time on."""
    spec = load_spec("orders_v2")
    options = kafka.stream_options(spec, pattern=spec.topic_pattern, start_ms=1000)
    assert options["subscribePattern"] == "orders_cdc_v[23]" and "subscribe" not in options
    assert options["startingTimestamp"] == "1000" and "startingOffsets" not in options


def test_stream_options():
    spec = load_spec("suppliers")
    assert kafka.stream_options(spec) == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "suppliers_cdc",
        "kafka.group.id": "tidemark_suppliers_cdc",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    more = kafka.stream_options(spec, servers="b:1", group="g", max_offsets=10, min_partitions=6)
    assert (more["kafka.group.id"], more["maxOffsetsPerTrigger"], more["minPartitions"]) == ("g", "10", "6")


def test_range_options():
    by_offset = kafka.offset_range_options("t", "b:1", {0: (5, 9), 2: (0, 3)})
    assert json.loads(by_offset["startingOffsets"]) == {"t": {"0": 5, "2": 0}}
    assert json.loads(by_offset["endingOffsets"]) == {"t": {"0": 9, "2": 3}}
    by_time = kafka.time_range_options("t", "b:1", 1000, 2000)  # no list of partitions to be incomplete
    assert (by_time["startingTimestamp"], by_time["endingTimestamp"]) == ("1000", "2000")


def test_master_lists(spark, rows, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps([{"supplier_id": "SUPP0001", "name": "A"}, {"supplier_id": "SUPP0002"}], indent=2))
    schema = T.StructType.fromDDL("supplier_id string, name string")
    assert rows(read_master(spark, str(tmp_path / "s.json"), schema)) == sorted([("SUPP0001", "A"), ("SUPP0002", None)], key=repr)
    (tmp_path / "o.json").write_text(json.dumps(["A1", "B2"], indent=2))
    assert rows(read_master_ids(spark, str(tmp_path / "o.json"), "order_id")) == [("A1",), ("B2",)]


def test_raw_scan_is_pruned(spark, tmp_path):
    import datetime as dt

    schema = T.StructType.fromDDL("id long, v string, partition_date date, op string")
    df = spark.range(10).selectExpr("id", "'x' v", "date_add(date'2025-01-01', cast(id as int)) partition_date", "'I' op")
    replace_partitions(df, str(tmp_path / "raw"), ["partition_date", "op"])
    got = scan_raw(spark, str(tmp_path / "raw"), schema, dt.date(2025, 1, 3), dt.date(2025, 1, 5), ["I"]).select("id")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_date" in plan and "ReadSchema: struct<id:bigint>" in plan
    assert got.count() == 3


def test_partitions_are_replaced_one_by_one(spark, rows, tmp_path):
    path = str(tmp_path / "zone")
    day = "partition_date string, v int"
    replace_partitions(spark.createDataFrame([("a", 1), ("b", 2)], day), path, ["partition_date"])
    replace_partitions(spark.createDataFrame([("b", 3)], day), path, ["partition_date"])
    assert rows(spark.read.parquet(path), "partition_date", "v") == [("a", 1), ("b", 3)]


def test_compaction_keeps_rows(spark, tmp_path):
    for batch in range(3):
        spark.range(5).selectExpr("id", "'2025-01-01' partition_date", "'I' op").write.partitionBy("partition_date", "op").parquet(
            f"{tmp_path}/raw/generation=g/batch_id={batch}"
        )
    raw = spark.read.parquet(f"{tmp_path}/raw")
    compact(raw, f"{tmp_path}/compacted")
    got = spark.read.parquet(f"{tmp_path}/compacted")
    assert got.count() == 15 and "batch_id" not in got.columns
    assert len(got.inputFiles()) == 1


def test_widening():
    old = T.StructType.fromDDL("a int, b string")
    evolution.check_widening(old, T.StructType.fromDDL("a bigint, b string, c string"))
    evolution.check_widening(old, T.StructType.fromDDL("a double, b string"))
    with pytest.raises(ValueError, match="needs a rewrite"):
        evolution.check_widening(old, T.StructType.fromDDL("a string, b string"))
    with pytest.raises(ValueError, match="must be nullable"):
        evolution.check_widening(old, T.StructType.fromDDL("a int, c int not null"))


def test_old_files_under_a_new_schema(spark, rows, tmp_path):
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(f"{tmp_path}/1")
    spark.createDataFrame([(2**40, "y", "z")], "a long, b string, c string").write.parquet(f"{tmp_path}/2")
    schema = T.StructType.fromDDL("a bigint, b string, c string")
    got = evolution.read_evolved(spark, [f"{tmp_path}/1", f"{tmp_path}/2"], schema)
    assert rows(got) == [(1, "x", None), (2**40, "y", "z")]


def test_unknown_keys(spark, rows):
    df = spark.createDataFrame([('{"a":1,"x":2}',), ('{"x":1,"y":2}',), ("junk",), (None,)], "value string")
    assert rows(evolution.unknown_keys(df, ["a"])) == [("x", 2), ("y", 1)]


def test_both_order_shapes_meet(spark, rows):
    v2 = spark.createDataFrame(
        [("I", "a", "CUST0007", "2025-01-01", "Placed", "Wallet", 10.0, "t")],
        "op string, order_id string, customer_id string, order_date string, order_status string, payment_type string, total_amount double, change_ts string",
    )
    orders = load_spec("orders")
    v1 = spark.createDataFrame([("b", "CUST00007", "2025-01-02", 5.0, "INR", "CARD", "SHIPPED", "t", "U")], orders.schema)
    got = conform.union_feeds([v1, conform.conform(v2, load_spec("orders_v2"), orders)])
    assert got.columns == orders.columns
    assert rows(got, "order_id", "customer_id", "order_amount", "currency", "payment_type", "status") == sorted(
        [("b", "CUST00007", 5.0, "INR", "CARD", "SHIPPED"), ("a", "CUST00007", 10.0, None, "WALLET", "PLACED")], key=repr
    )


def test_published_patches_come_back(spark, rows, tmp_path):
    spec = load_spec("customers")
    events = spark.createDataFrame([("CUST00001", "Ann", None, "2025-01-01T00:00:00", "U")], "customer_id string, name string, email string, change_ts string, op string")
    records = publish.to_records(events, ["customer_id"], spec.topic)
    assert records.first()["key"] == "U_CUST00001" and "email" not in records.first()["value"]
    publish.publish(records.select(
        F.col("key").cast("binary"), F.col("value").cast("binary"), "topic", "partition",
        F.lit(0).cast("long").alias("offset"), F.current_timestamp().alias("timestamp"), F.lit(0).alias("timestampType"),
    ), path=str(tmp_path / "topic"))
    got = decode(read_records(spark, str(tmp_path / "topic")), spec.schema)
    assert rows(got, "customer_id", "name", "email", "op") == [("CUST00001", "Ann", None, "U")]
    with pytest.raises(ValueError):
        publish.publish(records)


def test_supplier_feed_is_the_row_and_more(spark):
    row = spark.createDataFrame([("SUPP0001", "A")], "supplier_id string, name string")
    got = publish.stamp_events(row, F.lit("I"), publish.iso_text(F.timestamp_micros(F.lit(1500000))))
    assert tuple(got.first()) == ("SUPP0001", "A", "1970-01-01T00:00:01.500000", "I")


def test_replay(spark, rows):
    df = spark.createDataFrame([(0, i, f"2025-01-0{i + 1}T00:00:00") for i in range(5)] + [(1, 0, "2025-01-01T00:00:00")], "kafka_partition int, kafka_offset long, t string")
    df = df.withColumn("kafka_timestamp", F.to_timestamp("t"))
    assert rows(replay.by_offset(df, {0: (1, 3)}), "kafka_offset") == [(1,), (2,)]
    assert replay.by_offset(df, {}).count() == 0
    assert rows(replay.by_time(df, "2025-01-02", "2025-01-04"), "kafka_offset") == [(1,), (2,)]


def test_star(spark, rows):
    items = spark.createDataFrame([("i1", "o1", "p1"), ("i2", "o9", "p9")], "item_id string, order_id string, product_id string")
    orders = spark.createDataFrame([("o1", "c1")], "order_id string, customer_id string")
    customers = spark.createDataFrame([("c1", "Ann")], "customer_id string, customer string")
    products = spark.createDataFrame([("p1", "s1")], "product_id string, supplier_id string")
    suppliers = spark.createDataFrame([("s1", "Acme")], "supplier_id string, supplier string")
    got = enrich.order_lines(items, orders, customers, products, suppliers)
    assert rows(got, "item_id", "customer", "supplier") == [("i1", "Ann", "Acme"), ("i2", None, None)]
    assert rows(joins.orphans(items, orders, ["order_id"]), "item_id") == [("i2",)]
    assert rows(joins.known(items, orders, ["order_id"]), "item_id") == [("i1",)]
    with pytest.raises(ValueError):
        joins.with_parent(items, orders, ["order_id"], "full")
