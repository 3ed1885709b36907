"""Rules, zones and scorecards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.enrich import items_with_products, shipments_with_orders
from tidemark.operators.ingest import to_raw
from tidemark.operators.publish import iso_text
from tidemark.plans.feeds import EVENTS, records, Retail, table
from tidemark.plans.registry import FEED_SQL, query
from tidemark.session import scratch_path
from tidemark.streaming.sinks import replace_partitions

_CHECKED_SQL = f"""
WITH {FEED_SQL},
copies AS (
  SELECT user_id, change_ts, op FROM parsed GROUP BY user_id, change_ts, op HAVING count(*) > 1
),
checked AS (
  SELECT p.*, concat_ws(',',
      CASE WHEN p.user_id IS NULL THEN 'key_present' END,
      CASE WHEN p.change_ts IS NULL THEN 'change_ts_present' END,
      CASE WHEN p.op NOT IN ('I', 'U', 'D') THEN 'op_known' END,
      CASE WHEN p.corrupt IS NOT NULL THEN 'well_formed' END,
      CASE WHEN p.amount < 0.5 OR p.amount > 250 THEN 'amount_range' END,
      CASE WHEN NOT regexp_matches(p.user_id, '^[0-9]+$') THEN 'user_id_format' END,
      CASE WHEN p.op = 'I' AND (p.event_type IS NULL OR p.amount IS NULL) THEN 'insert_complete' END,
      CASE WHEN c.op IS NOT NULL THEN 'event_unique' END) AS failed_rules,
    p.user_id IS NULL OR p.change_ts IS NULL OR p.corrupt IS NOT NULL AS bad
  FROM parsed p LEFT JOIN copies c ON p.user_id = c.user_id AND p.change_ts = c.change_ts AND p.op = c.op
)
"""


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = to_raw(records(spark, sf_dir, dirty=True), EVENTS, lineage=True, corrupt=True)
    return quality.evaluate(rows, list(EVENTS.rules))


def _listed(df: DataFrame) -> DataFrame:
    return df.select(
        "kafka_offset", "user_id", "op", "partition_date",
        F.array_join(quality.FAILED, ",").alias("failed_rules"),
    )


@query(f"""{_CHECKED_SQL}
SELECT event_id AS kafka_offset, user_id, op, partition_date, failed_rules FROM checked
""")
def dq_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(_checked(spark, sf_dir))


def _zone(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    replace_partitions(rows, path, ["partition_date"])
    return spark.read.schema(rows.schema).parquet(path)


@query(f"""{_CHECKED_SQL}
SELECT event_id AS kafka_offset, user_id, op, partition_date, failed_rules FROM checked WHERE NOT bad
""")
def dq_trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trusted zone, written and read back."""
    good = quality.trusted(_checked(spark, sf_dir))
    return _listed(_zone(spark, good, "trusted"))


@query(f"""{_CHECKED_SQL}
SELECT event_id AS kafka_offset, user_id, op, partition_date, failed_rules FROM checked WHERE bad
""")
def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine zone, written and read back."""
    bad = quality.quarantined(_checked(spark, sf_dir))
    return _listed(_zone(spark, bad, "quarantine"))


@query(f"""{_CHECKED_SQL},
rules(rule_id, rule_type, severity) AS (VALUES
  ('key_present', 'not_null', 'error'), ('change_ts_present', 'not_null', 'error'),
  ('op_known', 'domain', 'error'), ('change_ts_parseable', 'parseable', 'error'),
  ('well_formed', 'well_formed', 'error'), ('amount_range', 'range', 'warn'),
  ('user_id_format', 'pattern', 'error'), ('insert_complete', 'required_on', 'error'),
  ('event_unique', 'unique', 'warn')),
counted AS (
  SELECT rule_id, rule_type, severity, (SELECT count(*) FROM checked) AS checked,
         (SELECT count(*) FROM checked c WHERE list_contains(string_split(c.failed_rules, ','), r.rule_id)) AS failed
  FROM rules r
)
SELECT *, checked - failed AS passed, round((checked - failed) / checked, 6) AS pass_rate FROM counted
""")
def dq_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scorecard(_checked(spark, sf_dir), list(EVENTS.rules))


_ORDER_RULES = [
    {"id": "amount_range", "type": "range", "column": "order_amount", "min": 1000, "max": 400000},
    {"id": "status_known", "type": "domain", "column": "status", "values": ["O", "F"], "severity": "warn"},
    {"id": "customer_live", "type": "referential", "column": "customer_id", "parent": "customers",
     "parent_column": "customer_id", "severity": "error"},
]


@query("""
SELECT o_orderkey AS order_id, concat_ws(',',
    CASE WHEN o_totalprice < 1000 OR o_totalprice > 400000 THEN 'amount_range' END,
    CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN 'status_known' END,
    CASE WHEN c_custkey IS NULL THEN 'customer_live' END) AS failed_rules
FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey
""")
def dq_order_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against their domains and against customers in good standing."""
    model = Retail(spark, sf_dir)
    live = model.customers.filter(F.col("balance") >= 0)
    checked = quality.evaluate(model.orders, _ORDER_RULES, {"customers": live})
    return checked.select("order_id", F.array_join(quality.FAILED, ",").alias("failed_rules"))


@query("""
SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS product_id, l_suppkey AS supplier_id,
       CAST(round(l_quantity * p_retailprice, 2) AS DECIMAL(18,2)) AS line_total,
       abs(l_extendedprice - l_quantity * p_retailprice) >= 0.01 AS broken
FROM lineitem JOIN part ON l_partkey = p_partkey
""")
def line_total_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity times unit price against the amount on the line."""
    model = Retail(spark, sf_dir)
    lines = items_with_products(model.order_items, model.products, ["price"], "inner")
    rule = {"id": "line_total", "type": "product", "column": "amount",
            "factors": ["quantity", "product_price"], "tolerance": 0.01}
    checked = quality.evaluate(lines, [rule])
    total = F.round(F.col("quantity") * F.col("product_price"), 2)
    return checked.select(
        "order_id", "line", "product_id", "supplier_id",
        total.cast("decimal(18,2)").alias("line_total"),
        (F.size(quality.FAILED) > 0).alias("broken"),
    )


@query("""
SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS product_id, l_suppkey AS supplier_id,
       date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) NOT BETWEEN 1 AND 7
""")
def ship_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments outside 1 to 7 days after the order."""
    model = Retail(spark, sf_dir)
    rows = shipments_with_orders(model.shipments, model.orders, ["order_date"])
    rule = {"id": "window", "type": "days_between", "column": "shipped", "from": "order_order_date",
            "min": 1, "max": 7}
    broken = quality.quarantined(quality.evaluate(rows, [rule]))
    return broken.select(
        "order_id", "line", "product_id", "supplier_id",
        F.datediff("shipped", "order_order_date").cast("bigint").alias("days"),
    )


_ALL_RULES = [
    {"id": "known_type", "type": "domain", "column": "event_type", "values": ["view", "click", "purchase", "signup"]},
    {"id": "short_user", "type": "pattern", "column": "user", "regex": "^[0-9]{1,2}$", "severity": "warn"},
    {"id": "once", "type": "unique", "columns": ["user", "event_type", "day"], "severity": "warn"},
    {"id": "time", "type": "parseable", "column": "change_ts"},
    {"id": "insert_whole", "type": "required_on", "op": "I", "columns": ["amount"]},
]


@query("""
WITH rows AS (
  SELECT event_id, event_type, CAST(user_id AS VARCHAR) AS "user", CAST(ts AS DATE) AS day,
         CASE WHEN event_id % 7 = 0 THEN 'soon' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS change_ts,
         CASE WHEN event_type = 'signup' THEN 'I' ELSE 'U' END AS op,
         CASE WHEN event_id % 5 > 0 THEN value END AS amount
  FROM events
)
SELECT event_id, concat_ws(',',
    CASE WHEN event_type NOT IN ('view', 'click', 'purchase', 'signup') THEN 'known_type' END,
    CASE WHEN NOT regexp_matches("user", '^[0-9]{1,2}$') THEN 'short_user' END,
    CASE WHEN "user" IS NOT NULL AND day IS NOT NULL AND count(*) OVER (PARTITION BY "user", event_type, day) > 1 THEN 'once' END,
    CASE WHEN change_ts = 'soon' THEN 'time' END,
    CASE WHEN op = 'I' AND amount IS NULL THEN 'insert_whole' END) AS failed_rules
FROM rows
""")
def dq_each_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain, pattern, unique, parseable and required-on-insert rules, each broken by some rows."""
    events = table(spark, sf_dir, "events")
    late = F.pmod("event_id", F.lit(7)) == 0
    rows = events.select(
        "event_id",
        "event_type",
        F.col("user_id").cast("string").alias("user"),
        F.col("ts").cast("date").alias("day"),
        F.when(late, "soon").otherwise(iso_text(F.col("ts"))).alias("change_ts"),
        F.when(F.col("event_type") == "signup", "I").otherwise("U").alias("op"),
        F.when(F.pmod("event_id", F.lit(5)) > 0, F.col("value")).alias("amount"),
    )
    checked = quality.evaluate(rows, _ALL_RULES)
    return checked.select("event_id", F.array_join(quality.FAILED, ",").alias("failed_rules"))
