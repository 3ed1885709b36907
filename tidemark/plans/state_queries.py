"""Deduplication, current state, history and differences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import dedup, diff, fold, history, joins, publish
from tidemark.operators.ordered import Along, along
from tidemark.plans.feeds import ORDER, table, typed_events
from tidemark.plans.registry import TYPED_SQL, query
from tidemark.session import scratch_path

KEY = ["user_id"]


@query(f"""
WITH {TYPED_SQL}
SELECT user_id, event_type, amount, op, change_at, event_id AS kafka_offset FROM typed
""")
def dedup_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with all purchases delivered a second time, later."""
    events = typed_events(spark, sf_dir).drop("props")
    again = events.filter(F.col("event_type") == "purchase").withColumn(
        "kafka_offset", F.col("kafka_offset") + F.lit(10**15)
    )
    once = dedup.drop_redelivered(events.unionByName(again), KEY, ["kafka_offset"], "change_at")
    return once.drop("kafka_partition")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate, l_partkey, l_suppkey) AS n FROM lineitem)
WHERE n = 1
""")
def dedup_business_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )
    return dedup.first_of(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


@query(f"""
WITH {TYPED_SQL}
SELECT user_id, event_type, amount, change_at FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY change_at DESC, event_id DESC) AS n FROM typed)
WHERE n = 1 AND op <> 'D'
""")
def current_state_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = typed_events(spark, sf_dir).drop("props")
    return fold.latest_rows(events, KEY, ORDER).select("user_id", "event_type", "amount", "change_at")


PATCH_STATE_SQL = f"""
WITH {TYPED_SQL},
barrier AS (
  SELECT *, max(change_at) FILTER (WHERE op = 'D') OVER (PARTITION BY user_id) AS deleted_at FROM typed
),
alive AS (SELECT * FROM barrier WHERE deleted_at IS NULL OR change_at > deleted_at)
SELECT user_id, max_by(event_type, change_at) AS event_type,
       max_by(patched, change_at) FILTER (WHERE patched IS NOT NULL) AS amount,
       max_by(props, change_at) AS props, max(change_at) AS change_at
FROM alive GROUP BY user_id
"""


@query(PATCH_STATE_SQL)
def current_state_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates carry an amount only with a purchase; deletes clear the row."""
    events = typed_events(spark, sf_dir, patch=True)
    return fold.fold_patches(events, KEY, ORDER, ["event_type", "amount", "props"], ["change_at"])


MIXED_SQL = f"""
WITH {TYPED_SQL},
mixed AS (SELECT *, event_id % 2 = 0 AS whole, CASE WHEN event_type = 'purchase' THEN amount END AS said FROM typed),
lives AS (
  SELECT *, count(*) FILTER (WHERE op = 'D' OR whole) OVER (PARTITION BY user_id ORDER BY change_at, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS life FROM mixed
),
states AS (
  SELECT user_id, change_at, event_id, op,
         CASE WHEN op <> 'D' THEN last_value(CASE WHEN op <> 'D' THEN said END IGNORE NULLS) OVER w END AS amount,
         CASE WHEN op <> 'D' THEN last_value(CASE WHEN op <> 'D' THEN event_type END IGNORE NULLS) OVER w END AS event_type
  FROM lives WINDOW w AS (PARTITION BY user_id, life ORDER BY change_at, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
"""


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other event is a whole row, the others are patches; both leave the amount out beside a purchase."""
    events = typed_events(spark, sf_dir, patch=True).drop("props")
    return events.withColumn(fold.FULL, F.pmod("kafka_offset", F.lit(2)) == 0)


@query(f"""
{MIXED_SQL}
SELECT user_id, event_type, amount, change_at FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY change_at DESC, event_id DESC) AS n FROM states)
WHERE n = 1 AND op <> 'D'
""")
def fold_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current rows of whole rows and patches together: a null clears in the one and says nothing in the other."""
    return fold.fold_patches(_mixed(spark, sf_dir), KEY, ORDER, ["event_type", "amount"], ["change_at"])


@query(f"""
{MIXED_SQL},
numbered AS (
  SELECT *, row_number() OVER w AS version, lead(change_at) OVER w AS valid_to
  FROM states WINDOW w AS (PARTITION BY user_id ORDER BY change_at, event_id)
)
SELECT user_id, event_type, amount, op, change_at AS valid_from, valid_to, version, valid_to IS NULL AS is_current
FROM numbered WHERE op <> 'D'
""")
def history_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version of those rows."""
    rows = history.folded_versions(_mixed(spark, sf_dir), KEY, ORDER, ["event_type", "amount"])
    return rows.drop("kafka_partition", "kafka_offset")


@query(f"""
WITH {TYPED_SQL},
h AS (
  SELECT user_id, event_type, amount, op, change_at AS valid_from,
         lead(change_at) OVER w AS valid_to, row_number() OVER w AS version
  FROM typed WINDOW w AS (PARTITION BY user_id ORDER BY change_at, event_id)
)
SELECT *, valid_to IS NULL AS is_current FROM h WHERE op <> 'D'
""")
def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = typed_events(spark, sf_dir).drop("props")
    return history.versions(events, KEY, ORDER).drop("kafka_partition", "kafka_offset")


@query(f"""
WITH {TYPED_SQL},
w AS (
  SELECT *, lag(op) OVER k AS last_op, lag(event_type) OVER k AS last_type, lag(amount) OVER k AS last_amount
  FROM typed WINDOW k AS (PARTITION BY user_id ORDER BY change_at, event_id)
)
SELECT user_id, change_at, op,
       CASE WHEN last_op <> 'D' THEN last_type END AS old_event_type,
       CASE WHEN last_op <> 'D' THEN last_amount END AS old_amount,
       CASE WHEN op <> 'D' THEN event_type END AS new_event_type,
       CASE WHEN op <> 'D' THEN amount END AS new_amount
FROM w
""")
def change_before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = typed_events(spark, sf_dir).drop("props")
    rows = history.images(events, KEY, ORDER, ["event_type", "amount"])
    return rows.drop("kafka_partition", "kafka_offset")


@query(f"""
WITH {TYPED_SQL},
epochs AS (
  SELECT *, count(*) FILTER (WHERE op = 'D') OVER (PARTITION BY user_id ORDER BY change_at, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS life FROM typed
),
states AS (
  SELECT user_id, change_at, event_id, op, last_value(patched IGNORE NULLS) OVER (
           PARTITION BY user_id, life ORDER BY change_at, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running FROM epochs
),
seen AS (
  SELECT *, lag(op) OVER w AS last_op, lag(running) OVER w AS last_running
  FROM states WINDOW w AS (PARTITION BY user_id ORDER BY change_at, event_id)
)
SELECT user_id, change_at, op, CASE WHEN last_op <> 'D' THEN last_running END AS old_amount,
       CASE WHEN op <> 'D' THEN running END AS new_amount
FROM seen
""")
def patch_before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of a feed whose updates leave out unchanged columns."""
    events = typed_events(spark, sf_dir, patch=True).drop("props", "event_type")
    rows = history.images(events, KEY, ORDER, ["amount"], patch=True)
    return rows.drop("kafka_partition", "kafka_offset")


@query(f"""
WITH {TYPED_SQL}
SELECT user_id, change_at, op, row_number() OVER (PARTITION BY user_id ORDER BY change_at, event_id) AS version
FROM typed
""")
def key_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = typed_events(spark, sf_dir).drop("props", "event_type", "amount")
    return history.number_events(events, KEY, ORDER).drop("kafka_partition", "kafka_offset")


_STATES_SQL = f"""
WITH {TYPED_SQL},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY change_at DESC) AS n FROM typed
),
early AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY change_at DESC) AS n FROM typed
  WHERE change_at < TIMESTAMP '2024-01-15'
),
old AS (SELECT * FROM early WHERE n = 1 AND op <> 'D'),
cur AS (SELECT * FROM ranked WHERE n = 1 AND op <> 'D')
"""


def _states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = typed_events(spark, sf_dir).drop("props")
    past = events.filter(F.col("change_at") < F.lit("2024-01-15").cast("timestamp_ntz"))
    return fold.latest_rows(past, KEY, ORDER), fold.latest_rows(events, KEY, ORDER)


_CUR_WITH_NULLS = "(SELECT * REPLACE (CASE WHEN event_type <> 'view' THEN amount END AS amount) FROM cur)"


def _states_with_nulls(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    old, new = _states(spark, sf_dir)
    return old, new.withColumn("amount", F.when(F.col("event_type") != "view", F.col("amount")))


@query(f"""
{_STATES_SQL}
SELECT CASE WHEN old.user_id IS NULL THEN 'I' WHEN cur.user_id IS NULL THEN 'D' ELSE 'U' END AS op,
       coalesce(old.user_id, cur.user_id) AS user_id, cur.event_type, cur.amount
FROM old FULL JOIN cur ON old.user_id = cur.user_id
WHERE old.user_id IS NULL OR cur.user_id IS NULL
   OR old.event_type IS DISTINCT FROM cur.event_type OR old.amount IS DISTINCT FROM cur.amount
""")
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes between the state in mid-January and the state now."""
    old, new = _states(spark, sf_dir)
    return diff.snapshot_diff(old, new, KEY, ["event_type", "amount"])


@query(f"""
{_STATES_SQL}
SELECT CASE WHEN old.user_id IS NULL THEN 'I' WHEN cur.user_id IS NULL THEN 'D' ELSE 'U' END AS op,
       coalesce(old.user_id, cur.user_id) AS user_id,
       CASE WHEN old.user_id IS NULL OR old.event_type IS DISTINCT FROM cur.event_type THEN cur.event_type END AS event_type,
       CASE WHEN old.user_id IS NULL OR old.amount IS DISTINCT FROM cur.amount THEN cur.amount END AS amount,
       CASE WHEN old.amount IS NOT NULL AND cur.user_id IS NOT NULL AND cur.amount IS NULL THEN 'amount' END AS cleared
FROM old FULL JOIN {_CUR_WITH_NULLS} cur ON old.user_id = cur.user_id
WHERE old.user_id IS NULL OR cur.user_id IS NULL
   OR old.event_type IS DISTINCT FROM cur.event_type OR old.amount IS DISTINCT FROM cur.amount
""")
def snapshot_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial updates between both states; the later one has no amount beside a view."""
    old, new = _states_with_nulls(spark, sf_dir)
    patches = diff.snapshot_diff(old, new, KEY, ["event_type", "amount"], patch=True)
    return patches.withColumn("cleared", F.array_join("cleared", ","))


@query(f"""
{_STATES_SQL}
SELECT user_id, event_type, amount FROM {_CUR_WITH_NULLS}
""")
def patch_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patches between two states, folded onto the first, give the second, nulls included."""
    old, new = _states_with_nulls(spark, sf_dir)
    columns = ["event_type", "amount"]
    first = old.select(*KEY, *columns, F.lit("I").alias("op"), F.lit(0).alias("at"))
    patches = diff.snapshot_diff(old, new, KEY, columns, patch=True).withColumn("at", F.lit(1))
    return fold.fold_patches(first.unionByName(patches, allowMissingColumns=True), KEY, ["at"], columns)


@query(f"""
{_STATES_SQL}
SELECT 'users_cdc' AS topic, op || '_' || CAST(user_id AS VARCHAR) AS key, user_id, event_type, amount, op,
       '2024-02-01T00:00:00.000000' AS change_ts
FROM (
  SELECT CASE WHEN old.user_id IS NULL THEN 'I' WHEN cur.user_id IS NULL THEN 'D' ELSE 'U' END AS op,
         coalesce(old.user_id, cur.user_id) AS user_id, cur.event_type, cur.amount
  FROM old FULL JOIN cur ON old.user_id = cur.user_id
  WHERE old.user_id IS NULL OR cur.user_id IS NULL
     OR old.event_type IS DISTINCT FROM cur.event_type OR old.amount IS DISTINCT FROM cur.amount)
""")
def publish_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second run publishes, after the state in mid-January went out with the first: the changed keys only."""
    path = scratch_path(spark, "published")
    state = publish.Published(spark, f"{path}/state")
    at = F.lit("2024-02-01T00:00:00.000000")
    last = 0
    for rows in _states(spark, sf_dir):
        rows = rows.select(*KEY, "event_type", "amount")
        last = state.run(rows, KEY, "users_cdc", at, lambda records, run: publish.publish(records, path=f"{path}/sent/run={run}"))
    sent = spark.read.parquet(f"{path}/sent/run={last}")
    value = F.from_json("value", "user_id long, event_type string, amount double, op string, change_ts string")
    return sent.select("topic", "key", value.alias("v")).select("topic", "key", "v.*")


@query("""
WITH versions AS (SELECT user_id, ts, value AS view_value FROM events WHERE event_type = 'view'),
facts AS (SELECT user_id, event_id, ts, value FROM events WHERE event_type = 'purchase')
SELECT f.user_id, f.event_id, f.ts, f.value, v.view_value
FROM facts f ASOF LEFT JOIN versions v ON f.user_id = v.user_id AND f.ts >= v.ts
""")
def asof_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every purchase with the version its user last viewed."""
    events = table(spark, sf_dir, "events")
    facts = events.filter(F.col("event_type") == "purchase").select("user_id", "event_id", "ts", "value")
    views = events.filter(F.col("event_type") == "view").select("user_id", "ts", "value")
    return joins.as_of(facts, views, KEY, "ts", "ts", {"value": "view_value"})


@query("""
WITH versions AS (
  SELECT user_id, ts, value AS view_value FROM (
    SELECT user_id, date_trunc('day', ts) AS ts, value,
           row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY event_id % 3 DESC, event_id DESC) AS n
    FROM events WHERE event_type = 'view')
  WHERE n = 1
),
facts AS (SELECT user_id, event_id, ts, value FROM events WHERE event_type = 'purchase')
SELECT f.user_id, f.event_id, f.ts, f.value, v.view_value
FROM facts f ASOF LEFT JOIN versions v ON f.user_id = v.user_id AND f.ts >= v.ts
""")
def asof_tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every purchase with the version in force, where a day's versions all begin at its midnight."""
    events = table(spark, sf_dir, "events")
    facts = events.filter(F.col("event_type") == "purchase").select("user_id", "event_id", "ts", "value")
    views = events.filter(F.col("event_type") == "view").select(
        "user_id",
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ts"),
        "value",
        F.pmod(F.col("event_id"), F.lit(3)).alias("part"),
        F.col("event_id").alias("position"),
    )
    return joins.as_of(facts, views, KEY, "ts", "ts", {"value": "view_value"}, tie=["part", "position"])


@query("""
SELECT event_id, event_type, row_number() OVER w AS version, lead(ts) OVER w AS next_at,
       lag(value) OVER w AS last_value
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)
""")
def hot_key_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position and neighbours within a handful of keys that hold the whole table: every one is cut in slices."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    want = Along(number="version", following={"next_at": F.col("ts")}, preceding={"last_value": F.col("value")})
    return along(events, ["event_type"], ["ts", "event_id"], want).drop("ts", "value")
