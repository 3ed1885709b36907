import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.joins import as_of, with_parent
from tidemark.operators.ordered import Along, along
from tidemark.operators.skew import MOST, NO_SKEW, SHARE, TASK_BYTES, parts_of, profile, replicate, spread, with_slice


@pytest.fixture(scope="module")
def events(spark):
    """A third of all rows belong to one key; another tenth have no key."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit(7)).when(n % 10 == 1, F.lit(None)).otherwise(F.pmod(F.xxhash64(n), F.lit(900)) + 100)
    return spark.range(30000).select(
        key.cast("long").alias("k"),
        F.timestamp_micros(F.pmod(F.xxhash64(n, F.lit(1)), F.lit(10**9))).alias("at"),
        n.alias("seq"),
        F.when(F.pmod(F.xxhash64(n, F.lit(2)), F.lit(5)) == 0, n).alias("v"),
    ).cache()


@pytest.fixture(scope="module")
def skew(events):
    return profile(events, ["k"], "at")


def test_hot_keys_are_found_and_bounded(events, skew):
    hashed = {r["k"]: r["h"] for r in events.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    assert hashed[7] in skew.hot and hashed[None] in skew.hot
    assert len(skew.hot) <= SHARE and len(skew.splits) < SHARE
    assert len(skew.hot) < 10


def test_parts_follow_the_input():
    """The largest slice or salt stays a task's share as the input grows."""
    assert parts_of(0) == SHARE
    sizes = [1 << 36, 1 << 38, 1 << 39]
    assert [size / parts_of(size) for size in sizes] == [TASK_BYTES] * 3
    assert parts_of(1 << 60) == MOST


def test_order_column_without_values(spark):
    """Nothing to cut by: hot keys are found all the same."""
    rows = spark.range(100).select(F.lit(1).alias("k"), F.lit(None).cast("timestamp").alias("at"))
    skew = profile(rows, ["k"], "at")
    assert len(skew.hot) == 1 and skew.splits == ()
    assert along(rows, ["k"], ["at"], Along(number="n"), skew).agg(F.max("n")).first()[0] == 100


def test_rows_of_a_key_alone_are_spread(spark):
    """Child rows that hold only their key take many salts."""
    rows = spark.range(1000, numPartitions=16).select(F.lit(1).alias("k"))
    salts = spread(rows, ["k"], profile(rows, ["k"])).select("_salt").distinct().count()
    assert salts > 8


def test_scans_of_a_sliced_window(events, skew):
    """Two reads beyond the profile: all rows for the window, hot keys for the edges."""
    plan = along(events, ["k"], ["at", "seq"], Along(number="n"), skew)._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    assert leaves.size() == 2


def test_versions_at_one_instant(spark):
    facts = spark.createDataFrame([(1, 5)], "k long, t long")
    versions = [(1, 5, "a", 0, 7), (1, 5, "b", 1, 2), (1, 5, "c", 0, 9)]
    for rows in (versions, versions[::-1]):
        v = spark.createDataFrame(rows, "k long, t long, name string, part int, off int")
        got = as_of(facts, v, ["k"], "t", "t", {"name": "name"}, tie=["part", "off"])
        assert got.first()["name"] == "b"


def test_slices_are_even(events, skew):
    sliced = with_slice(events, ["k"], "at", skew, "s")
    biggest = sliced.groupBy("k", "s").count().agg(F.max("count")).first()[0]
    assert biggest < 30000 * 4 / SHARE
    hot = sliced.filter("k = 7").select("s", F.unix_micros("at").alias("at")).collect()
    assert all(r["s"] == sum(x <= r["at"] for x in skew.splits) for r in hot)


def test_salted_rows_are_even(events, skew):
    biggest = spread(events, ["k"], skew).groupBy("k", "_salt").count().agg(F.max("count")).first()[0]
    assert biggest < 30000 * 4 / SHARE


def everything():
    return Along(
        number="n",
        following={"next_at": F.col("at"), "next_v": F.col("v")},
        preceding={"last_v": F.col("v")},
        latest={"seen": F.col("v")},
        before={"seen_before": F.col("v")},
    )


def test_slicing_changes_nothing(events, skew):
    """Every value equals that of a plain window over the whole key."""
    w = Window.partitionBy("k").orderBy("at", "seq")
    plain = events.select(
        *events.columns,
        F.row_number().over(w).cast("long").alias("n"),
        F.lead("at").over(w).alias("next_at"),
        F.lead("v").over(w).alias("next_v"),
        F.lag("v").over(w).alias("last_v"),
        F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("seen"),
        F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("seen_before"),
    )
    for s in (skew, NO_SKEW):
        got = along(events, ["k"], ["at", "seq"], everything(), s).select(*plain.columns)
        assert got.count() == plain.count()
        assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_changes_nothing(spark, events, skew, how):
    parent = spark.range(0, 700).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    plain = events.join(parent, ["k"], how)
    got = with_parent(events, parent, ["k"], how, skew=skew)
    assert got.columns == plain.columns
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()


def test_only_hot_parents_are_copied(spark, skew):
    parent = spark.range(0, 700).select(F.col("id").alias("k"))
    assert replicate(parent, ["k"], skew).count() == 700 - 1 + SHARE


def test_large_parent_takes_the_salted_way(spark, events):
    parent = spark.range(0, 700).select(F.col("id").alias("k"), F.lit(1).alias("w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = with_parent(events, parent, ["k"])
        assert "_salt" in got._jdf.queryExecution().optimizedPlan().toString()
        assert got.count() == events.join(parent, "k").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("skewed", [True, False])
def test_as_of_against_brute_force(spark, skewed):
    facts = [(k, t, i) for i, (k, t) in enumerate([(1, 5), (1, 1), (1, 10), (2, 3), (3, 3), (1, 12), (1, 20), (None, 3)])]
    versions = [(1, 2, "a", "I"), (1, 10, "b", "U"), (1, 12, None, "D"), (1, 15, "c", "I"), (2, 4, "x", "I")]
    f = spark.createDataFrame(facts, "k long, t long, i long")
    v = spark.createDataFrame(versions, "k long, t long, name string, op string")

    def expected(k, t):
        best = max(((vt, n, op) for vk, vt, n, op in versions if vk == k and vt <= t), default=None)
        return None if best is None or best[2] == "D" else best[1]

    skew = profile(f, ["k"], "t") if skewed else NO_SKEW
    got = as_of(f, v, ["k"], "t", "t", {"name": "name"}, skew)
    assert {r["i"]: r["name"] for r in got.collect()} == {i: expected(k, t) for k, t, i in facts}


def test_empty_table_has_no_skew(spark):
    empty = spark.createDataFrame([], "k long, t long")
    assert not profile(empty, ["k"], "t")
    assert along(empty, ["k"], ["t"], Along(number="n")).isEmpty()
