"""The log of live folders, offset ranges, and replays that land every offset once."""

import datetime as dt
import json

import pytest
from test_streaming import message, put

from tidemark.functions.parse import CORRUPT, LINEAGE_FIELDS
from tidemark.operators import offsets
from tidemark.operators.ingest import to_raw
from tidemark.operators.offsets import inside, landed_ranges, merge_ranges, missing_ranges, outside
from tidemark.sources.files import raw_schema, read_records
from tidemark.spec import load_spec
from tidemark.streaming import manifest as module
from tidemark.streaming.manifest import Conflict, Manifest, replay_once
from tidemark.streaming.sinks import write_batch

SPEC = load_spec("orders")
SCHEMA = raw_schema(SPEC, LINEAGE_FIELDS)


def epoch(spark, tmp_path, number, numbers, start):
    """One epoch folder of the messages ``numbers``, offsets from ``start``."""
    put(spark, tmp_path / f"topic{number}", [json.dumps(message(i)) for i in numbers], start)
    records = read_records(spark, f"{tmp_path}/topic{number}")
    folder = f"generation=g/batch_id={number}"
    write_batch(to_raw(records, SPEC, lineage=True), f"{tmp_path}/raw/{folder}")
    return folder


@pytest.fixture
def zone(spark, tmp_path):
    manifest = Manifest(spark, f"{tmp_path}/raw")
    for number, start in enumerate((0, 10, 30)):
        manifest.add(epoch(spark, tmp_path, number, range(start, start + 10), start))
    return manifest


def held(manifest, *args):
    return sorted(r.kafka_offset for r in manifest.scan(SCHEMA, *args).collect())


def test_ranges(spark, rows, monkeypatch):
    monkeypatch.setattr(offsets, "STRETCH", 4)  # ranges cross stretches
    df = spark.createDataFrame([("t", 0, o) for o in [*range(11), 5, 5, 13, 14, 20]] + [("t", 1, 7), ("u", 0, None)], "topic string, partition int, offset long")
    got = landed_ranges(df)
    assert rows(got) == [("t", 0, 0, 10), ("t", 0, 13, 14), ("t", 0, 20, 20), ("t", 1, 7, 7)]
    assert rows(missing_ranges(got)) == [("t", 0, 11, 12), ("t", 0, 15, 19)]
    more = spark.createDataFrame([("t", 0, 2, 100), ("t", 0, 3, 4), ("t", 0, 101, 102)], offsets.RANGES)
    assert rows(merge_ranges(got.unionByName(more))) == [("t", 0, 0, 102), ("t", 1, 7, 7)]
    new = spark.createDataFrame([("t", 0, o) for o in (10, 11, 14, 19)] + [("t", 2, 0), ("t", 0, None)], "topic string, partition int, offset long")
    assert rows(outside(new, got)) == sorted([("t", 0, 11), ("t", 0, 19), ("t", 2, 0), ("t", 0, None)], key=repr)


def test_places_of_offsets_as_by_hand(spark, rows, monkeypatch):
    """Ranges and what lies in them, over words, short and long stretches, negative and huge offsets."""
    monkeypatch.setattr(offsets, "STRETCH", 32)
    monkeypatch.setattr(offsets, "SHORT", 8)
    schema = "topic string, partition int, offset long"
    base = {("t", 0): -100, ("t", None): 0, (None, 0): 2**62 + 1}
    landed = [(t, p, b + o) for (t, p), b in base.items() for o in range(300) if not (o % 37 == 5 or 90 <= o < 94 or o > 250 and o % 2)]
    got = landed_ranges(spark.createDataFrame(landed * 2, schema))
    assert sorted(o for r in got.collect() for o in range(r["first"], r["last"] + 1)) == sorted(o for _, _, o in landed)
    assert rows(merge_ranges(got)) == rows(got)
    asked = [(t, p, b + o) for (t, p), b in base.items() for o in range(-70, 370)] + [("t", 0, None), ("u", 0, 3)]
    df = spark.createDataFrame(asked + asked[:5], schema)
    held = set(landed)
    assert rows(outside(df, got)) == sorted((r for r in asked + asked[:5] if r not in held), key=repr)
    assert rows(inside(df, got)) == sorted((r for r in asked + asked[:5] if r in held), key=repr)
    assert inside(df, got.limit(0)).isEmpty() and outside(df, got.limit(0)).count() == len(asked) + 5


def test_few_ranges_move_no_records(spark, tmp_path):
    """Ranges that are few are broadcast; records are neither shuffled nor laid into one sequence with them."""
    spark.createDataFrame([("t", 0, 5, 9)], offsets.RANGES).write.parquet(f"{tmp_path}/ranges")
    df = spark.range(1000).selectExpr("'t' topic", "0 partition", "id offset", "repeat('x', 20) value")
    left = outside(df, spark.read.schema(offsets.RANGES).parquet(f"{tmp_path}/ranges"))
    assert left.count() == 995
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


def test_a_day_lists_its_own_folders(spark, zone):
    day = dt.date(2025, 1, 2)
    files = zone.scan(SCHEMA, day, day).inputFiles()
    assert files and all("partition_date=2025-01-02" in f for f in files)
    assert zone.scan(SCHEMA, day, day).count() == sum(i % 3 == 1 for i in [*range(20), *range(30, 40)])
    assert zone.scan(SCHEMA, dt.date(2030, 1, 1)).isEmpty()


def test_a_folder_without_commit_is_not_seen(spark, tmp_path, zone):
    epoch(spark, tmp_path, 9, range(50, 60), 50)
    assert held(Manifest(spark, zone.zone)) == [*range(20), *range(30, 40)]


def test_a_repeated_epoch_counts_once(spark, tmp_path, zone):
    zone.add(epoch(spark, tmp_path, 2, range(30, 40), 30))
    assert len(held(zone)) == 60 - 20 and len(held(zone)) == len(spark.read.parquet(f"{zone.zone}/generation=g/batch_id=2").collect()) + 20


def test_gaps_are_noted_once(spark, rows, tmp_path, zone):
    gap = [("orders_cdc", 0, 20, 29)]
    assert rows(zone.lost()) == gap
    zone.add(epoch(spark, tmp_path, 3, range(40, 45), 40))
    assert rows(zone.lost()) == gap
    put(spark, tmp_path / "late", [json.dumps(message(i)) for i in range(20, 30)], 20)
    replay_once(read_records(spark, f"{tmp_path}/late"), SPEC, zone, SCHEMA, lineage=True)
    assert held(zone) == list(range(45))
    assert rows(zone.lost()) == gap and missing_ranges(zone.ranges()).isEmpty()


@pytest.mark.parametrize("replace", [False, True])
def test_replay_lands_every_offset_once(spark, tmp_path, zone, replace):
    put(spark, tmp_path / "again", [json.dumps(message(i, status="NEW")) for i in range(5, 35)], 5)
    records = read_records(spark, f"{tmp_path}/again")
    for _ in range(2):
        replay_once(records.unionByName(records), SPEC, zone, SCHEMA, replace, lineage=True)
        assert held(Manifest(spark, zone.zone)) == list(range(40))
    status = {r.kafka_offset: r.status for r in zone.scan(SCHEMA).collect()}
    assert {o for o, s in status.items() if s == "NEW"} == (set(range(5, 35)) if replace else set(range(20, 30)))
    assert replay_once(records.limit(0), SPEC, zone, SCHEMA, replace, lineage=True) is None


def test_a_replacing_replay_leaves_other_days_where_they_are(spark, tmp_path, zone):
    """Only the days that hold replayed offsets are written again."""
    for i in (4, 7, 31):  # of the second day, in the first and the third folder
        put(spark, tmp_path / "again", [json.dumps(message(i, status="NEW"))], i)
    folder = replay_once(read_records(spark, f"{tmp_path}/again"), SPEC, zone, SCHEMA, replace=True, lineage=True)
    one, two, three = (f"2025-01-0{d}" for d in (1, 2, 3))
    assert zone.days() == {
        "generation=g/batch_id=0": [one, three], "generation=g/batch_id=1": [one, two, three], "generation=g/batch_id=2": [one, three], folder: [two]
    }
    status = {r.kafka_offset: r.status for r in zone.scan(SCHEMA).collect()}
    assert held(Manifest(spark, zone.zone)) == sorted(status) == [*range(20), *range(30, 40)]
    assert {o for o, s in status.items() if s == "NEW"} == {4, 7, 31}


def test_merge_of_some_days(spark, zone):
    before = held(zone)
    day = dt.date(2025, 1, 1)
    folder = zone.merge(SCHEMA, day, day)
    assert held(zone) == before
    assert {f for f, days in zone.days(day, day).items()} == {folder}
    assert {f for f in zone.scan(SCHEMA, day, day).inputFiles() if "merged" not in f} == set()
    assert len(zone.days(dt.date(2025, 1, 2))) == 3
    assert zone.merge(SCHEMA, day, day) is None and held(Manifest(spark, zone.zone)) == before


def test_two_writers(spark, tmp_path, zone):
    """Commits of two writers follow each other; a folder is replaced by one of them only."""
    one, two = Manifest(spark, zone.zone), Manifest(spark, zone.zone)
    one.add(epoch(spark, tmp_path, 4, range(40, 50), 40))
    two.add(epoch(spark, tmp_path, 5, range(50, 60), 50))
    assert held(one.refresh()) == held(two) == [*range(20), *range(30, 60)]
    first = next(iter(one.live))
    days = one.live[first]["days"]
    one.commit(drop={first: days})
    with pytest.raises(Conflict):
        two.commit(drop={first: days})


def test_long_logs_are_stated_anew(spark, tmp_path, zone, monkeypatch):
    monkeypatch.setattr(module, "STATE_EVERY", 4)
    late = Manifest(spark, zone.zone)
    entry = next(iter(zone.live.values()))
    for n in range(20):
        zone.commit({f"generation=h/batch_id={n}": entry})
    assert Manifest(spark, zone.zone).live.keys() == zone.live.keys() == late.refresh().live.keys()
    assert len(list((tmp_path / "raw" / "_manifest" / "log").glob("*.json"))) <= 8


def test_adopting_a_zone(spark, tmp_path):
    epoch(spark, tmp_path, 0, range(10), 0)
    zone = Manifest(spark, f"{tmp_path}/raw")
    assert not zone.exists()
    zone.adopt()
    assert held(zone) == list(range(10)) and CORRUPT not in SCHEMA.fieldNames()


def test_versions_read_alike_before_and_after_a_rewrite(spark, rows, tmp_path):
    """Types that Parquet widens stay as they are; others are cast, and rewritten once."""
    from pyspark.sql import types as T

    ddl = ", kafka_key string, kafka_topic string, kafka_partition int, kafka_offset long, kafka_timestamp timestamp, partition_date date, op string"
    steps = ["a int, b int, c long", "a long, b string, c decimal(12,2)", "a long, b string, c decimal(12,2), d string"]
    zone = Manifest(spark, f"{tmp_path}/raw")
    for n, step in enumerate(steps):
        schema = T.StructType.fromDDL(step + ddl)
        values = f"{n}, {n + 7}, {n}" + (", 'new'" if n == 2 else "")
        df = spark.sql(f"SELECT {values}, 'k', 't', 0, {n}L, timestamp'2025-01-01', date'2025-01-0{n + 1}', 'I'").toDF(*schema.fieldNames())
        df = df.select(*[df[f.name].cast(f.dataType) for f in schema.fields])
        write_batch(df, f"{zone.zone}/generation=g/batch_id={n}")
        zone.add(f"generation=g/batch_id={n}", schema)
    newest = T.StructType.fromDDL(steps[-1] + ddl)
    assert zone.outdated(newest) == ["generation=g/batch_id=0"]
    before = rows(zone.scan(newest))
    assert [(r[0], r[1], str(r[2]), r[3]) for r in before] == [(0, "7", "0.00", None), (1, "8", "1.00", None), (2, "9", "2.00", "new")]
    folder = zone.rewrite(newest)
    assert rows(Manifest(spark, zone.zone).scan(newest)) == before and folder in zone.live
    assert zone.outdated(newest) == [] and zone.rewrite(newest) is None
    narrower = T.StructType.fromDDL("b int" + ddl)
    assert rows(zone.scan(narrower).select("b")) == [(7,), (8,), (9,)]
