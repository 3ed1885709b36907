import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedup, diff, fold, history, publish
from tidemark.operators.skew import profile
from tidemark.streaming.state import compact_state, read_state, state_writer

SCHEMA = "id string, at long, seq long, op string, status string, amount double"
KEYS, ORDER, COLUMNS = ["id"], ["at", "seq"], ["status", "amount"]


def replayed(events):
    """The state the feed's own dictionary would hold."""
    state = {}
    for id_, at, seq, op, status, amount in sorted(events, key=lambda e: (e[1], e[2])):
        if op == "D":
            state.pop(id_, None)
            continue
        row = state.setdefault(id_, {"status": None, "amount": None})
        row |= {k: v for k, v in (("status", status), ("amount", amount)) if v is not None}
    return sorted(((i, r["status"], r["amount"]) for i, r in state.items()), key=repr)


CASES = {
    "patch": [("a", 1, 0, "I", "Placed", 10.0), ("a", 2, 1, "U", None, 11.0)],
    "delete": [("a", 1, 0, "I", "Placed", 10.0), ("a", 2, 1, "D", None, None)],
    "insert again keeps nothing old": [
        ("a", 1, 0, "I", "Placed", 10.0), ("a", 2, 1, "D", None, None), ("a", 3, 2, "I", "Placed", None),
    ],
    "update first": [("a", 1, 0, "U", "Delivered", None), ("a", 2, 1, "I", None, 5.0)],
    "update after delete": [("a", 1, 0, "D", None, None), ("a", 2, 1, "U", None, 5.0)],
    "equal times go by offset": [("a", 1, 1, "U", "second", None), ("a", 1, 0, "I", "first", 1.0)],
    "late update before the delete": [("a", 5, 0, "D", None, None), ("a", 4, 1, "U", "late", 1.0)],
}


@pytest.mark.parametrize("events", CASES.values(), ids=CASES)
def test_patch_fold(spark, rows, events):
    df = spark.createDataFrame(events, SCHEMA)
    assert rows(fold.fold_patches(df, KEYS, ORDER, COLUMNS)) == replayed(events)


def random_events(seed, n=400):
    r = random.Random(seed)
    return [
        (
            f"k{r.choice([0, 0, 0, *range(12)])}", r.randrange(60), i, r.choices("IUD", [6, 3, 1])[0],
            r.choice([None, "p", "d"]), r.choice([None, float(r.randrange(100))]),
        )
        for i in range(n)
    ]


def nulled(events):
    """Deletes carry their key alone."""
    return [e if e[3] != "D" else (*e[:4], None, None) for e in events]


@pytest.mark.parametrize("seed", range(3))
def test_batches_in_any_order_and_twice(spark, rows, seed):
    events = nulled(random_events(seed))
    r = random.Random(seed + 100)
    shuffled = events + r.sample(events, 50)
    r.shuffle(shuffled)
    cuts = sorted(r.sample(range(len(shuffled)), 3))
    batches = [shuffled[a:b] for a, b in zip([0, *cuts], [*cuts, len(shuffled)])]
    parts = [
        fold.fold_partial(spark.createDataFrame(b, SCHEMA), KEYS, ORDER, COLUMNS) for b in batches if b
    ]
    states = parts[0]
    for p in parts[1:]:
        states = fold.fold_merge(states.unionByName(p), KEYS)
    assert rows(fold.fold_result(states, KEYS, COLUMNS)) == replayed(events)


def test_state_folders(spark, rows, tmp_path):
    """Deltas, a replayed epoch, compaction, more deltas: always the whole feed's state."""
    events = nulled(random_events(9))
    write = state_writer(str(tmp_path), KEYS, ORDER, COLUMNS)
    for epoch in range(4):
        write(spark.createDataFrame(events[epoch::6], SCHEMA), epoch)
    write(spark.createDataFrame(events[2::6], SCHEMA), 2)
    compact_state(spark, str(tmp_path), KEYS)
    for epoch in (4, 5):
        write(spark.createDataFrame(events[epoch::6], SCHEMA), epoch)

    def live():
        return rows(fold.fold_result(read_state(spark, str(tmp_path), KEYS), KEYS, COLUMNS))

    assert live() == replayed(events)
    assert compact_state(spark, str(tmp_path), KEYS).endswith("version=1")
    assert live() == replayed(events)


def test_full_rows(spark, rows):
    events = [("a", 1, 0, "I", "x", 1.0), ("a", 2, 1, "U", "y", None), ("b", 1, 2, "I", "z", 1.0), ("b", 3, 3, "D", None, None)]
    got = fold.latest_rows(spark.createDataFrame(events, SCHEMA), KEYS, ORDER)
    assert rows(got, "id", "status", "amount") == [("a", "y", None)]


def test_redelivered_copies(spark, rows):
    df = spark.createDataFrame(
        [("a", "t1", "I", 5), ("a", "t1", "I", 2), ("a", "t1", "U", 9), ("b", "t1", "I", 7)],
        "id string, change_ts string, op string, kafka_offset long",
    )
    got = dedup.drop_redelivered(df, ["id"], ["kafka_offset"])
    assert rows(got) == [("a", "t1", "I", 2), ("a", "t1", "U", 9), ("b", "t1", "I", 7)]


def test_copies_are_dropped_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 3 as k", "id")
    plan = dedup.first_of(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("skewed", [True, False])
def test_patch_images_against_replay(spark, skewed):
    events = nulled(random_events(4, 300))
    df = spark.createDataFrame(events, SCHEMA)
    skew = profile(df, KEYS, "at") if skewed else None
    got = {r["seq"]: r for r in history.images(df, KEYS, ORDER, COLUMNS, patch=True, skew=skew).collect()}
    state = {}
    for id_, at, seq, op, status, amount in sorted(events, key=lambda e: (e[1], e[2])):
        old = state.get(id_, (None, None))
        new = (None, None) if op == "D" else tuple(n if n is not None else o for n, o in zip((status, amount), old))
        state[id_] = new
        r = got[seq]
        assert (r["old_status"], r["old_amount"]) == old
        assert (r["new_status"], r["new_amount"]) == new
    assert len(got) == len(events)


def test_versions(spark, rows):
    events = [("a", 1, 0, "I", "x", 1.0), ("a", 4, 1, "U", "y", 2.0), ("a", 6, 2, "D", None, None), ("a", 9, 3, "I", "z", 3.0)]
    got = history.versions(spark.createDataFrame(events, SCHEMA), KEYS, ORDER)
    assert rows(got, "valid_from", "valid_to", "version", "is_current", "status") == [
        (1, 4, 1, False, "x"), (4, 6, 2, False, "y"), (9, None, 4, True, "z"),
    ]


def test_diff_turns_old_into_new(spark, rows):
    old = spark.createDataFrame([("a", "x", 1.0), ("b", "y", None), ("c", "z", 3.0)], "id string, status string, amount double")
    new = spark.createDataFrame([("a", "x", 1.0), ("b", "y", 2.0), ("d", None, 4.0)], "id string, status string, amount double")
    assert rows(diff.snapshot_diff(old, new, KEYS, COLUMNS)) == sorted(
        [("U", "b", "y", 2.0), ("D", "c", None, None), ("I", "d", None, 4.0)], key=repr
    )
    patches = diff.snapshot_diff(old, new, KEYS, COLUMNS, patch=True)
    assert ("U", "b", None, 2.0, None) in rows(patches, "op", "id", *COLUMNS, "cleared")
    base = old.select("id", F.lit(0).alias("at"), F.lit("I").alias("op"), *COLUMNS)
    feed = base.unionByName(patches.withColumn("at", F.lit(1)), allowMissingColumns=True)
    assert rows(fold.fold_patches(feed, KEYS, ["at"], COLUMNS)) == rows(new)


def test_patches_carry_nulls(spark, rows):
    """A value that becomes null is null after the patch, and so it is in the images."""
    old = spark.createDataFrame([("a", "x", 1.0), ("b", None, 5.0)], "id string, status string, amount double")
    new = spark.createDataFrame([("a", None, 1.0), ("b", "y", None)], "id string, status string, amount double")
    patches = diff.snapshot_diff(old, new, KEYS, COLUMNS, patch=True).withColumn("at", F.lit(1))
    assert rows(patches, "id", "cleared") == [("a", ["status"]), ("b", ["amount"])]
    feed = old.select("id", F.lit(0).alias("at"), F.lit("I").alias("op"), *COLUMNS).unionByName(patches, allowMissingColumns=True)
    assert rows(fold.fold_patches(feed, KEYS, ["at"], COLUMNS)) == rows(new)
    seen = history.images(feed, KEYS, ["at"], COLUMNS, patch=True).filter("at = 1")
    assert rows(seen, "id", "old_status", "new_status", "old_amount", "new_amount") == [("a", "x", None, 1.0, 1.0), ("b", None, "y", 5.0, None)]


def test_whole_rows_and_patches(spark, rows):
    """A null clears in a whole row, says nothing in a patch, and a delete forgets all."""
    events = [
        (1, 1, "I", True, "a", 1), (1, 2, "U", False, None, 2), (1, 3, "U", True, None, 3), (1, 4, "U", False, "b", None),
        (2, 1, "I", False, "x", None), (2, 2, "D", True, "ignored", 9), (2, 3, "U", False, None, 5),
        (3, 1, "I", True, "y", 1), (3, 2, "D", False, None, None),
    ]
    df = spark.createDataFrame(events, "k int, at int, op string, full boolean, a string, b int")
    assert rows(fold.fold_patches(df, ["k"], ["at"], ["a", "b"])) == sorted([(1, "b", 3), (2, None, 5)], key=repr)
    parts = [fold.fold_partial(df.where(c), ["k"], ["at"], ["a", "b"]) for c in ("at % 2 = 0", "at % 2 = 1", "at > 1")]
    merged = fold.fold_merge(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["k"])
    assert rows(fold.fold_result(merged, ["k"], ["a", "b"])) == sorted([(1, "b", 3), (2, None, 5)], key=repr)
    seen = history.folded_versions(df, ["k"], ["at"], ["a", "b"])
    assert rows(seen, "k", "version", "valid_from", "valid_to", "a", "b") == sorted([
        (1, 1, 1, 2, "a", 1), (1, 2, 2, 3, "a", 2), (1, 3, 3, 4, None, 3), (1, 4, 4, None, "b", 3),
        (2, 1, 1, 2, "x", None), (2, 3, 3, None, None, 5), (3, 1, 1, 2, "y", 1),
    ], key=repr)


def test_published_difference(spark, rows, tmp_path):
    """A run that stops before its mark is done again; patches carry what changed."""
    sent = {}
    send = lambda records, run: sent.__setitem__(run, rows(records.select("key", "value")))
    state, at = publish.Published(spark, str(tmp_path)), F.lit("t")
    table = lambda *r: spark.createDataFrame(r, "k string, a string, b int")
    state.run(table(("1", "x", 1), ("2", "y", None)), ["k"], "t", at, send)
    assert [k for k, _ in sent[0]] == ["I_1", "I_2"]

    def fail(records, run):
        raise RuntimeError("broker is away")

    with pytest.raises(RuntimeError):
        state.run(table(("1", "x", 2)), ["k"], "t", at, fail)
    assert state.run(table(("1", None, 2)), ["k"], "t", at, send, patch=True) == 1
    assert sent[1] == [("D_2", '{"op":"D","k":"2","change_ts":"t"}'), ("U_1", '{"op":"U","k":"1","b":2,"cleared":["a"],"change_ts":"t"}')]
    state.run(table(("1", None, 2)), ["k"], "t", at, send)
    assert sent[2] == [] and state.runs() == [1, 2]
