import json

import pytest
from test_streaming import message, put

from tidemark import jobs
from tidemark.operators.quality import QualityThresholdExceeded
from tidemark.spec import load_spec
from tidemark.streaming.metrics import read_drift, read_metrics, settle


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Topics of two tables, ingested by the job."""
    root = tmp_path_factory.mktemp("lake")
    good = [json.dumps(message(i, customer_id="CUST00001", order_date="2025-01-01", currency="INR", payment_type="CARD", status="PLACED")) for i in range(6)]
    bad = ["junk", json.dumps(message(90, currency="USD"))]
    put(spark, root / "topics" / "orders_cdc", good + bad)
    put(spark, root / "topics" / "customers_cdc", [json.dumps({"customer_id": "CUST00001", "change_ts": "2025-01-01", "op": "I"})])
    jobs.main(["ingest", "--root", str(root), "--files", f"{root}/topics", "--tables", "orders", "customers", "--once"], spark)
    return root


def test_ingest_lands_raw_rows(spark, lake):
    raw = spark.read.parquet(f"{lake}/raw/orders")
    assert raw.count() == 8
    assert {"kafka_offset", "_corrupt_record", "partition_date", "op"} <= set(raw.columns)


def test_check_splits_the_rows(spark, rows, lake):
    for _ in range(2):  # the second run replaces the first
        jobs.main(["check", "--root", str(lake), "--tables", "orders"], spark)
        assert spark.read.parquet(f"{lake}/trusted/orders").count() == 6
        held = spark.read.parquet(f"{lake}/quarantine/orders")
        assert rows(held.selectExpr("order_id", "array_contains(failed_rules, 'well_formed')")) == sorted(
            [(None, True), ("0000005A", False)], key=repr
        )
    card = {r["rule_id"]: r["failed"] for r in spark.read.parquet(f"{lake}/scorecards/orders").collect()}
    assert card["currency_known"] == 1 and card["customer_exists"] == 0 and card["well_formed"] == 1


def test_check_of_some_days_leaves_the_others(spark, lake):
    jobs.main(["check", "--root", str(lake), "--tables", "orders"], spark)
    jobs.main(["check", "--root", str(lake), "--tables", "orders", "--first", "2025-01-02", "--last", "2025-01-02"], spark)
    assert spark.read.parquet(f"{lake}/trusted/orders").count() == 6


def test_scorecards_of_ranges_stand_side_by_side(spark, lake):
    jobs.main(["check", "--root", str(lake), "--tables", "orders"], spark)
    jobs.main(["check", "--root", str(lake), "--tables", "orders", "--first", "2025-01-02", "--last", "2025-01-02"], spark)
    cards = spark.read.parquet(f"{lake}/scorecards/orders").filter("rule_id = 'currency_known'")
    assert {(r["first"], r["last"]): r["checked"] for r in cards.collect()}[("begin", "end")] == 8
    assert cards.count() == 2


def test_parents_are_alive(spark, tmp_path):
    """A deleted customer dangles, and so does everybody where none was landed."""
    order = message(1, customer_id="CUST00001", order_date="2025-01-01", currency="INR", payment_type="CARD", status="PLACED")
    put(spark, tmp_path / "topics" / "orders_cdc", [json.dumps(order), json.dumps({**order, "order_id": "0000002A", "customer_id": "CUST00002"})])
    put(spark, tmp_path / "topics" / "orders_cdc_v2", [json.dumps({"op": "I", "order_id": "a", "order_date": "2025-01-01"})])
    steps = [{"customer_id": "CUST00001", "change_ts": "2025-01-01", "op": "I"}, {"customer_id": "CUST00002", "change_ts": "2025-01-01", "op": "I"}, {"customer_id": "CUST00002", "change_ts": "2025-01-03", "op": "D"}]
    put(spark, tmp_path / "topics" / "customers_cdc", [json.dumps(s) for s in steps])
    read = ["--root", str(tmp_path), "--files", f"{tmp_path}/topics", "--once"]
    check = ["check", "--root", str(tmp_path), "--max-share", "1"]
    jobs.main(["ingest", *read, "--tables", "orders", "orders_v2"], spark)
    jobs.main([*check, "--tables", "orders", "orders_v2"], spark)
    found = lambda: {r["rule_id"]: r["failed"] for r in spark.read.parquet(f"{tmp_path}/scorecards/orders").collect()}
    assert found()["customer_exists"] == 2
    jobs.main(["ingest", *read, "--tables", "customers"], spark)
    jobs.main([*check, "--tables", "orders"], spark)
    assert found()["customer_exists"] == 1


def test_derived_columns_survive(spark, tmp_path):
    """Compacted, trusted and registered tables hold what raw rows hold."""
    put(spark, tmp_path / "topics" / "orders_cdc_v2", [json.dumps({"op": "I", "order_id": "a", "order_date": "2025-01-01"})])
    place = ["--root", str(tmp_path), "--tables", "orders_v2"]
    jobs.main(["ingest", *place, "--files", f"{tmp_path}/topics", "--once"], spark)
    jobs.main(["compact", *place], spark)
    raw = spark.read.parquet(f"{tmp_path}/raw/orders_v2")
    packed = spark.read.parquet(f"{tmp_path}/compacted/orders_v2")
    assert set(packed.columns) == set(raw.columns) - {"generation", "batch_id"}
    assert packed.filter("order_date_parsed is not null and ingestion_ts is not null").count() == 1
    jobs.main(["check", *place, "--zone", "compacted", "--max-share", "1"], spark)
    jobs.main(["register", *place], spark)
    assert {"order_date_parsed", "ingestion_ts", "failed_rules"} <= set(spark.table("trusted_orders_v2").columns)
    spark.sql("DROP TABLE trusted_orders_v2")


def test_register_before_any_row(spark, tmp_path):
    jobs.main(["register", "--root", str(tmp_path), "--tables", "orders"], spark)
    assert spark.table("trusted_orders").isEmpty()
    spark.sql("DROP TABLE trusted_orders")


def test_check_aborts_above_the_threshold(spark, lake):
    with pytest.raises(QualityThresholdExceeded):
        jobs.main(["check", "--root", str(lake), "--tables", "orders", "--max-share", "0.1"], spark)


def test_compact(spark, lake):
    jobs.main(["compact", "--root", str(lake), "--tables", "orders"], spark)
    assert spark.read.parquet(f"{lake}/compacted/orders").count() == 8


def test_check_reads_the_compacted_zone(spark, lake):
    jobs.main(["compact", "--root", str(lake), "--tables", "orders", "customers"], spark)
    jobs.main(["check", "--root", str(lake), "--tables", "orders", "--zone", "compacted"], spark)
    assert spark.read.parquet(f"{lake}/trusted/orders").count() == 6


def test_register(spark, lake):
    jobs.main(["check", "--root", str(lake), "--tables", "orders"], spark)
    for _ in range(2):
        jobs.main(["register", "--root", str(lake), "--tables", "orders"], spark)
    assert spark.sql("SELECT count(*) FROM trusted_orders WHERE partition_date >= '2025-01-02'").first()[0] == 4
    spark.sql("DROP TABLE trusted_orders")


def test_unknown_table(spark, tmp_path):
    with pytest.raises(SystemExit, match="no config for nothing"):
        jobs.main(["ingest", "--root", str(tmp_path), "--tables", "nothing"], spark)


def test_chain_of_two_order_feeds(spark, rows, tmp_path):
    """Redelivered, patched and deleted orders of two shapes become one current table."""
    first = {"customer_id": "CUST00001", "order_date": "2025-01-01", "order_amount": 150.0, "currency": "INR", "payment_type": "CARD", "status": "PLACED"}
    at = "2025-01-0{}T00:00:00"
    steps = [{**first, "order_id": i, "op": "I", "change_ts": at.format(1)} for i in ("a", "b")]
    put(spark, tmp_path / "topics" / "orders_cdc", [json.dumps(s) for s in [*steps, steps[0]]])
    later = [
        {"op": "U", "order_id": "a", "order_status": "Delivered", "change_ts": at.format(2) + "+00:00"},
        {"op": "D", "order_id": "b", "change_ts": at.format(3) + "+00:00"},
        {"op": "I", "order_id": "c", "customer_id": "CUST0007", "order_date": at.format(2), "order_status": "Placed", "payment_type": "UPI", "total_amount": 200.0, "change_ts": at.format(2) + "+00:00"},
    ]
    put(spark, tmp_path / "topics" / "orders_cdc_v2", [json.dumps(s) for s in later])
    put(spark, tmp_path / "topics" / "customers_cdc", [json.dumps({"customer_id": "CUST00001", "change_ts": "2025-01-01", "op": "I"})])
    place = ["--root", str(tmp_path), "--tables", "orders", "orders_v2", "customers"]
    jobs.main(["ingest", *place, "--files", f"{tmp_path}/topics", "--once"], spark)
    jobs.main(["check", *place, "--max-share", "1"], spark)
    for _ in range(3):  # each run replaces the one before
        jobs.main(["curate", *place], spark)
        assert rows(spark.table("current_orders"), "order_id", "status", "order_amount", "customer_id") == [
            ("a", "DELIVERED", 150.0, "CUST00001"), ("c", "PLACED", 200.0, "CUST00007"),
        ]
    assert spark.table("history_customers").count() == 1
    assert rows(spark.table("history_orders"), "order_id", "status", "order_amount", "version", "is_current") == [
        ("a", "DELIVERED", 150.0, 2, True), ("a", "PLACED", 150.0, 1, False), ("b", "PLACED", 150.0, 1, False), ("c", "PLACED", 200.0, 1, True),
    ]

    def sent(run):
        """What a run of the publishing job sends."""
        jobs.main(["publish", *place[:3], "orders", "--out", f"{tmp_path}/out"], spark)
        records = spark.read.parquet(f"{tmp_path}/out/orders_cdc/run={run}")
        return rows(records.selectExpr("key", "get_json_object(value, '$.status')"))

    assert sent(0) == [("I_a", "DELIVERED"), ("I_c", "PLACED")]
    assert sent(1) == []
    last = [
        {**first, "order_id": "a", "op": "U", "currency": None, "payment_type": "UPI", "status": "SHIPPED", "change_ts": at.format(5)},
        {"op": "D", "order_id": "c", "change_ts": at.format(5) + "+00:00"},
    ]
    put(spark, tmp_path / "topics" / "orders_cdc", [json.dumps(last[0])], start=50)
    put(spark, tmp_path / "topics" / "orders_cdc_v2", [json.dumps(last[1])], start=50)
    jobs.main(["ingest", *place, "--files", f"{tmp_path}/topics", "--once"], spark)
    jobs.main(["check", *place, "--max-share", "1"], spark)
    jobs.main(["curate", *place], spark)
    assert sent(2) == [("D_c", None), ("U_a", "SHIPPED")]
    for kind in ("current_orders", "history_orders", "current_customers", "history_customers"):
        spark.sql(f"DROP TABLE {kind}")


@pytest.mark.parametrize("replace", [[], ["--replace"]])
def test_replay_of_a_landed_range_changes_nothing(spark, rows, lake, replace):
    def zones():
        raw = jobs.landed(spark, load_spec("orders"), str(lake))
        return rows(raw.drop("kafka_key")), rows(spark.read.parquet(f"{lake}/trusted/orders").select("order_id", "kafka_offset"))

    jobs.main(["check", "--root", str(lake), "--tables", "orders"], spark)
    before = zones()
    place = ["--root", str(lake), "--tables", "orders"]
    jobs.main(["replay", *place, *replace, "--files", f"{lake}/topics", "--since", "2025-01-01", "--until", "2025-01-02"], spark)
    jobs.main(["check", *place], spark)
    assert zones() == before and len(before[0]) == 8


def test_merge_keeps_rows_and_lets_epochs_go(spark, rows, lake):
    put(spark, lake / "topics" / "orders_cdc", [json.dumps(message(i)) for i in range(20, 24)], start=100)
    place = ["--root", str(lake), "--tables", "orders"]
    jobs.main(["ingest", *place, "--files", f"{lake}/topics", "--once"], spark)
    spec = load_spec("orders")
    before = jobs.landed(spark, spec, str(lake))
    seen, files = rows(before.drop("kafka_key")), set(before.inputFiles())
    jobs.main(["merge", *place], spark)
    assert rows(before.drop("kafka_key")) == seen  # a reader from before the merge goes on
    after = jobs.landed(spark, spec, str(lake))
    assert rows(after.drop("kafka_key")) == seen and len(after.inputFiles()) < len(files)
    jobs.main(["merge", *place], spark)  # nothing to merge: what the first one covered is deleted
    left = spark.read.parquet(f"{lake}/raw/orders")
    assert left.count() == len(seen) and "merged" in {r[0] for r in left.select("generation").distinct().collect()}


def test_unknown_fields_are_recorded_by_batch(spark, rows, tmp_path):
    place = ["--root", str(tmp_path), "--tables", "orders"]
    for n, more in enumerate(({}, {"gift": 1, "note": "x"}, {"note": "y"})):
        put(spark, tmp_path / "topics" / "orders_cdc", [json.dumps(message(i, **more)) for i in range(3)] + ["junk", "[1]"], start=10 * n)
        jobs.main(["ingest", *place, "--files", f"{tmp_path}/topics", "--once"], spark)
        settle(spark)
    path = f"{tmp_path}/metrics/orders"
    by_batch = spark.read.parquet(f"{path}_drift").selectExpr("batch_id", "concat_ws(',', fields) f", "messages")
    assert rows(by_batch) == [(1, "gift,note", 3), (2, "note", 3)]
    assert rows(read_drift(spark, path)) == [("orders", "gift", 3), ("orders", "note", 6)]
    assert read_metrics(spark, path).count() == 3
    assert read_drift(spark, f"{tmp_path}/metrics/none").isEmpty()
