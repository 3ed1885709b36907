import datetime as dt
import json
import logging
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryException

from tidemark.operators.ingest import to_raw
from tidemark.operators.skew import profile
from tidemark.sources.files import RECORD_SCHEMA, raw_schema, read_records, scan_raw, stream_records
from tidemark.spec import load_spec
from tidemark.streaming import operators as ops
from tidemark.streaming.ingest import ingest_tables, start_ingest
from tidemark.streaming.metrics import BatchMetrics, late_rows, read_metrics, settle
from tidemark.streaming.sinks import epoch_path, latest_run, write_batch

ONCE = {"availableNow": True}
SPEC = load_spec("orders")


def message(i, **more):
    return {"order_id": f"{i:08X}", "order_amount": 100.0 + i, "change_ts": f"2025-01-0{1 + i % 3}T00:00:0{i % 10}", "op": "IU"[i % 2], **more}


def put(spark, path, texts, start=0):
    data = [(bytearray(b"k"), bytearray(t.encode()), "orders_cdc", 0, start + i, dt.datetime(2025, 1, 1), 0) for i, t in enumerate(texts)]
    spark.createDataFrame(data, RECORD_SCHEMA).coalesce(1).write.mode("append").parquet(str(path))


@pytest.fixture
def topic(spark, tmp_path):
    """Three files, the last with rows that cannot be dated."""
    path = tmp_path / "topic"
    for n in range(3):
        texts = [json.dumps(message(n * 10 + i)) for i in range(10)]
        if n == 2:
            texts += ["junk", json.dumps({"order_id": "x", "op": "I"})]
        put(spark, path, texts, n * 100)
    return str(path)


def start(spark, topic, tmp_path, **kw):
    return start_ingest(
        stream_records(spark, topic, files_per_batch=1), SPEC, f"{tmp_path}/raw", f"{tmp_path}/cp", ONCE, **kw
    )


def raw(spark, tmp_path):
    return scan_raw(spark, f"{tmp_path}/raw", raw_schema(SPEC))


def test_stream_equals_batch(spark, rows, topic, tmp_path):
    run = start(spark, topic, tmp_path)
    run.awaitTermination()
    assert len(run.recentProgress) == 3
    batch = to_raw(read_records(spark, topic), SPEC)
    got = raw(spark, tmp_path)
    assert rows(got, *SPEC.columns, "partition_date") == rows(batch, *SPEC.columns, "partition_date")
    assert got.filter(F.col("partition_date") == F.lit("1900-01-01")).count() == 2


def test_restart_reads_only_what_is_new(spark, topic, tmp_path):
    start(spark, topic, tmp_path).awaitTermination()
    put(spark, topic, [json.dumps(message(7))], 900)
    start(spark, topic, tmp_path).awaitTermination()
    assert raw(spark, tmp_path).count() == 33
    assert len(list((tmp_path / "raw").iterdir())) == 1


def test_epoch_written_twice_leaves_one_copy(spark, topic, tmp_path):
    rows = to_raw(read_records(spark, topic), SPEC)
    path = epoch_path(f"{tmp_path}/raw", "q", 0)
    write_batch(rows, path)
    write_batch(rows.filter(F.col("partition_date") > F.lit("2025-01-01")), path)
    write_batch(rows, path)
    assert raw(spark, tmp_path).count() == 32


def test_new_checkpoint_does_not_overwrite(spark, topic, tmp_path):
    start(spark, topic, tmp_path).awaitTermination()
    start_ingest(stream_records(spark, topic), SPEC, f"{tmp_path}/raw", f"{tmp_path}/cp2", ONCE).awaitTermination()
    assert raw(spark, tmp_path).count() == 64


def test_failed_batch_is_not_committed(spark, topic, tmp_path):
    (tmp_path / "raw").write_text("a file where the zone should be")
    with pytest.raises(StreamingQueryException):
        start(spark, topic, tmp_path).awaitTermination()
    assert not [f for f in (tmp_path / "cp" / "commits").glob("*") if f.name.isdigit()]
    (tmp_path / "raw").unlink()
    start(spark, topic, tmp_path).awaitTermination()
    assert raw(spark, tmp_path).count() == 32


def test_metrics_count_each_row_once(spark, topic, tmp_path):
    run = start(spark, topic, tmp_path, corrupt=True)
    run.awaitTermination()
    seen = [p.observedMetrics["orders"] for p in run.recentProgress]
    assert [s["rows"] for s in seen] == [10, 10, 12] == [p.numInputRows for p in run.recentProgress]
    assert [(s["fallback_rows"], s["malformed_rows"]) for s in seen] == [(0, 0), (0, 0), (2, 1)]


def test_tables_by_config_with_metrics_table(spark, topic, tmp_path, caplog):
    put(spark, tmp_path / "suppliers", [json.dumps({"supplier_id": "SUPP0001", "change_ts": "2025-01-01", "op": "I"})])
    paths = {"orders": topic, "suppliers": str(tmp_path / "suppliers")}
    caplog.set_level(logging.INFO, "tidemark")
    specs = [SPEC, load_spec("suppliers")]
    for q in ingest_tables(spark, specs, lambda s: stream_records(spark, paths[s.table]), str(tmp_path), ONCE):
        q.awaitTermination()
    found = {}
    for _ in range(60):  # listeners report after the batch
        found = {t: list((tmp_path / "metrics" / t).glob("_SUCCESS")) for t in paths if (tmp_path / "metrics" / t).exists()}
        if len(found) == 2 and all(found.values()) and "wrote 1 rows" in caplog.text and "wrote 32 rows" in caplog.text:
            break
        time.sleep(0.5)
    got = {r["table"]: r for t in paths for r in spark.read.parquet(f"{tmp_path}/metrics/{t}").collect()}
    assert (got["orders"]["rows"], got["orders"]["fallback_rows"], got["suppliers"]["rows"]) == (32, 2, 1)
    assert got["orders"]["duration_ms"] > 0
    assert "2 rows without a usable date" in caplog.text
    assert spark.read.parquet(f"{tmp_path}/raw/suppliers").count() == 1


def test_empty_batch_writes_nothing(spark, tmp_path):
    empty = to_raw(spark.createDataFrame([], RECORD_SCHEMA), SPEC)
    write_batch(empty, epoch_path(f"{tmp_path}/raw", "q", 0))
    assert not list((tmp_path / "raw").rglob("*.parquet"))


def stream(spark, tmp_path, name, frames):
    path = str(tmp_path / name)
    for f in frames:
        f.coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)  # files are taken by age
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", "1").parquet(path)


def finish(spark, tmp_path, df, name="out"):
    q = df.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp-{name}").trigger(**ONCE).start(f"{tmp_path}/{name}")
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}")


def timed(spark, data, ddl):
    return spark.createDataFrame(data, ddl).withColumn("at", F.to_timestamp("at"))


@pytest.mark.parametrize("spread_by", [None, ["off"]])
def test_copies_across_batches(spark, rows, tmp_path, spread_by):
    ddl = "k string, at string, off long"
    a = timed(spark, [("a", "2025-01-01T00:00:00", 1), ("a", "2025-01-01T00:00:00", 2), ("b", "2025-01-01T00:00:01", 3)], ddl)
    b = timed(spark, [("a", "2025-01-01T00:00:00", 9), ("b", "2025-01-01T00:00:02", 10)], ddl)
    src = stream(spark, tmp_path, "in", [a, b])
    got = finish(spark, tmp_path, ops.drop_duplicates(src, ["k", "at"], "at", "1 hour", spread_by))
    assert rows(got.select("k", F.second("at"))) == [("a", 0), ("b", 1), ("b", 2)]


def test_rates_close_with_the_watermark(spark, rows, tmp_path):
    ddl = "op string, at string"
    a = timed(spark, [("I", "2025-01-01T00:00:10"), ("I", "2025-01-01T00:00:50"), ("U", "2025-01-01T00:00:59")], ddl)
    b = timed(spark, [("I", "2025-01-01T00:10:00")], ddl)
    got = finish(spark, tmp_path, ops.rates(stream(spark, tmp_path, "in", [a, b]), "at", "2 minutes", "1 minute", ["op"]))
    assert rows(got, "op", "events") == [("I", 2), ("U", 1)]


@pytest.mark.parametrize("skewed", [True, False])
def test_orders_meet_shipments(spark, rows, tmp_path, skewed):
    orders = [timed(spark, [("o1", "2025-01-01T00:00:00"), ("o2", "2025-01-02T00:00:00")], "order_id string, at string")]
    shipments = [
        timed(spark, [("o1", 1, "2025-01-03T00:00:00"), ("o1", 2, "2025-01-20T00:00:00")], "order_id string, line int, at string"),
        timed(spark, [("o2", 3, "2025-01-03T00:00:00"), ("o9", 4, "2025-01-03T00:00:00")], "order_id string, line int, at string"),
    ]
    kw = {"skew": profile(shipments[0], ["order_id"])} if skewed else {}
    left = stream(spark, tmp_path, "o", orders).withColumnRenamed("at", "ordered")
    right = stream(spark, tmp_path, "s", shipments).withColumnRenamed("at", "shipped")
    got = ops.join_within(left, right, "order_id", "ordered", "shipped", "10 days", "1 day", "7 days", **kw)
    assert rows(finish(spark, tmp_path, got), "order_id", "line") == [("o1", 1), ("o2", 3)]


def test_state_store_over_batches(spark, rows, tmp_path):
    from test_state import COLUMNS, KEYS, ORDER, SCHEMA, nulled, random_events, replayed

    from tidemark.operators.fold import latest_rows
    from tidemark.streaming.stateful import STATE_STORE, live_state

    events = nulled(random_events(21, 200))
    frames = [spark.createDataFrame(events[i::2], SCHEMA).withColumn("at", F.timestamp_seconds("at")) for i in range(2)]
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        upserts = live_state(stream(spark, tmp_path, "in", frames), KEYS, ORDER, COLUMNS)
        out = f"{tmp_path}/out"
        q = (
            upserts.writeStream.outputMode("update")
            .foreachBatch(lambda df, e: df.selectExpr("*", f"{e} as epoch").write.mode("overwrite").parquet(f"{out}/b={e}"))
            .option("checkpointLocation", f"{tmp_path}/cp").trigger(**ONCE).start()
        )
        q.awaitTermination()
    finally:
        for k in STATE_STORE:
            spark.conf.unset(k)
    # late events keep the position but change the row, hence the epoch
    last = latest_rows(spark.read.parquet(out), KEYS, ["position", "epoch"])
    assert rows(last, *KEYS, *COLUMNS) == replayed(events)


def test_metrics_beyond_what_progress_keeps(spark, tmp_path):
    """Every batch is in the table, however few reports the query itself keeps."""
    for i in range(5):
        put(spark, tmp_path / "topic", [json.dumps(message(10 * i + k)) for k in range(4)])
    path = str(tmp_path / "metrics")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        spark.streams.addListener(BatchMetrics(spark, SPEC.table, path))
        feed = stream_records(spark, str(tmp_path / "topic"), files_per_batch=1)
        start_ingest(feed, SPEC, str(tmp_path / "raw"), str(tmp_path / "ck"), {"availableNow": True}).awaitTermination()
        settle(spark)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    seen = read_metrics(spark, path)
    assert seen.count() >= 5 and seen.agg({"rows": "sum"}).first()[0] == 20


def test_orders_without_shipment_come_with_the_watermark(spark, rows, tmp_path):
    """State is let go of as time goes on, and what is later than the delay is dropped and counted."""
    days = range(1, 28)
    orders = [timed(spark, [(f"o{d}", f"2025-01-{d:02}T00:00:00")], "order_id string, at string") for d in days]
    shipped = [timed(spark, [(f"o{d}", d, f"2025-01-{d:02}T12:00:00")] if d % 3 else [("x", 0, f"2025-01-{d:02}T12:00:00")], "order_id string, line int, at string") for d in days]
    orders[20] = orders[20].unionByName(timed(spark, [("late", "2025-01-03T00:00:00")], "order_id string, at string"))

    def ordered(name, frames):
        path = str(tmp_path / name)
        for f in frames:
            f.coalesce(1).write.mode("append").parquet(path)
        return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", "1").parquet(path)

    left = ordered("o", orders).withColumnRenamed("at", "ordered")
    right = ordered("s", shipped).withColumnRenamed("at", "shipped")
    df = ops.left_within(left, right, "order_id", "ordered", "shipped", "2 days", "0 days", "2 days")
    q = df.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(**ONCE).start(f"{tmp_path}/out")
    q.awaitTermination()
    got = {r.order_id: r.line for r in spark.read.schema(df.schema).parquet(f"{tmp_path}/out").collect()}
    assert {o for o, line in got.items() if line} == {f"o{d}" for d in days if d % 3}
    closed = {o for o, line in got.items() if line is None}
    assert closed <= {f"o{d}" for d in days if d % 3 == 0} and {f"o{d}" for d in range(3, 20, 3)} <= closed and "late" not in got
    held = [s.numRowsTotal for p in q.recentProgress for s in p.stateOperators]
    assert max(held) <= 20 < 2 * len(days)  # a few days of both sides, not the whole stream
    assert sum(late_rows(p) for p in q.recentProgress) == 1


def test_each_batch_meets_the_parent_of_its_time(spark, rows, tmp_path):
    """A hot key of a batch is salted where the parent is too large to broadcast."""
    parent = lambda name: spark.createDataFrame([(i, name) for i in range(50)], "k int, name string")
    parent("old").write.parquet(f"{tmp_path}/parent/run=0")
    frames = [spark.createDataFrame([(0 if i % 2 else i, 1000 * n + i) for i in range(400)], "k int, v int") for n in range(2)]
    seen = []

    def write(batch, epoch):
        seen.append("_salt" in batch._jdf.queryExecution().optimizedPlan().toString())
        batch.write.mode("overwrite").parquet(f"{tmp_path}/out/b={epoch}")
        parent("new").write.parquet(f"{tmp_path}/parent/run=1", mode="overwrite")
        spark.createDataFrame([], "k int").write.parquet(f"{tmp_path}/parent/run=2", mode="overwrite")
        (tmp_path / "parent" / "run=2" / "_SUCCESS").unlink()  # a run that is still being written

    newest = lambda s: s.read.schema("k int, name string").parquet(latest_run(s, f"{tmp_path}/parent"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run = ops.with_current_parent(newest, ["k"], write)
        src = stream(spark, tmp_path, "in", frames)
        src.writeStream.foreachBatch(run).option("checkpointLocation", f"{tmp_path}/cp").trigger(**ONCE).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = rows(spark.read.parquet(f"{tmp_path}/out"), "k", "v", "name")
    want = [(k, v, (None if k >= 50 else "old" if v < 1000 else "new")) for f in frames for k, v in f.collect()]
    assert got == sorted(want, key=repr) and seen == [True, True]
    assert latest_run(spark, f"{tmp_path}/none") is None
