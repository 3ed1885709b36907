"""The given tables, and the change feeds Spark derives from them.

``events`` is a feed by nature: its user is the key, its time the change time,
its id the offset. The table is clean, so some kinds of rows are sent damaged:
truncated text, no change time, a wrong type, an unknown key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import padded_id
from tidemark.functions.parse import decode, instant
from tidemark.operators.publish import iso_text
from tidemark.session import use_utc
from tidemark.spec import load_spec, spec_from

ORDER = ["change_at", "kafka_partition", "kafka_offset"]

EVENTS = spec_from(
    {
        "topic": "events_cdc",
        "primary_key": ["user_id"],
        "columns": {
            "user_id": "string",
            "event_type": "string",
            "amount": "double",
            "props": "string",
            "change_ts": "string",
            "op": "string",
        },
        "rules": [
            {"id": "key_present", "type": "not_null", "column": "user_id"},
            {"id": "change_ts_present", "type": "not_null", "column": "change_ts"},
            {"id": "op_known", "type": "domain", "column": "op", "values": ["I", "U", "D"]},
            {"id": "change_ts_parseable", "type": "parseable", "column": "change_ts"},
            {"id": "well_formed", "type": "well_formed"},
            {"id": "amount_range", "type": "range", "column": "amount", "min": 0.5, "max": 250.0, "severity": "warn"},
            {"id": "user_id_format", "type": "pattern", "column": "user_id", "regex": "^\\d+$"},
            {"id": "insert_complete", "type": "required_on", "op": "I", "columns": ["event_type", "amount"]},
            {"id": "event_unique", "type": "unique", "columns": ["user_id", "change_ts", "op"], "severity": "warn"},
        ],
    },
    "events",
)
ORDERS_V2 = load_spec("orders_v2")
ORDERS = load_spec("orders")


# The columns of the given tables; stating them saves reading a footer per table.
COLUMNS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def plain_time(*columns: str) -> dict[str, Column]:
    """Timestamps without zone, as the tables have them."""
    return {c: F.col(c).cast("timestamp_ntz") for c in columns}


def event_op() -> Column:
    return F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")


def _event_json(amount: Column, *more: Column) -> Column:
    return F.to_json(
        F.struct(
            F.col("user_id").cast("string").alias("user_id"),
            "event_type",
            amount.alias("amount"),
            "props",
            "change_ts",
            event_op().alias("op"),
            *more,
        )
    )


def as_records(events: DataFrame, dirty: bool = False, patch: bool = False) -> DataFrame:
    """``events`` rows as broker records; works on a table and on a stream."""
    at = F.col("ts").cast("timestamp")
    kind, value = F.col("event_type"), F.col("value")
    change_ts = iso_text(at)
    amount = F.when(kind == "purchase", value) if patch else value
    if dirty:
        change_ts = F.when(~((kind == "view") & (value < 5)), change_ts)
    rows = events.withColumn("change_ts", change_ts).withColumn("text", _event_json(amount))
    text = F.col("text")
    if dirty:
        text = (
            F.when((kind == "error") & (value < 10), F.expr("substr(text, 1, length(text) - 5)"))
            .when((kind == "click") & (value >= 100), _event_json(F.lit("n/a")))
            .when((kind == "purchase") & (value >= 100), _event_json(value, F.lit("yes").alias("coupon")))
            .otherwise(text)
        )
    return rows.select(
        F.concat_ws("_", event_op(), F.col("user_id").cast("string")).cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.lit("events_cdc").alias("topic"),
        F.pmod(F.col("event_id"), F.lit(3)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        (at + F.make_dt_interval(secs=F.floor("value").cast("decimal(18,6)"))).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def records(spark: SparkSession, sf_dir: str, dirty: bool = False, patch: bool = False) -> DataFrame:
    return as_records(table(spark, sf_dir, "events"), dirty, patch)


def parsed_events(spark: SparkSession, sf_dir: str, patch: bool = False) -> DataFrame:
    """The clean feed, decoded, with its order columns."""
    rows = decode(records(spark, sf_dir, patch=patch), EVENTS.schema, lineage=True)
    return rows.withColumn("change_at", instant("change_ts"))


def order_variant_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the second shape: whole inserts, partial updates, bare deletes."""
    at = iso_text(F.col("o_orderdate").cast("timestamp"))
    insert, delete = F.col("o_orderstatus") == "O", F.col("o_orderstatus") == "P"
    op = F.when(insert, "I").when(delete, "D").otherwise("U")
    event = F.struct(
        op.alias("op"),
        F.concat(at, F.lit("+00:00")).alias("change_ts"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(insert, padded_id("CUST", F.col("o_custkey"), 4)).alias("customer_id"),
        F.when(insert, F.concat(at, F.lit("+00:00"))).alias("order_date"),
        F.when(~delete, F.when(insert, "Placed").otherwise("Delivered")).alias("order_status"),
        F.when(insert, F.substring("o_orderpriority", 3, 20)).alias("payment_type"),
        F.when(~delete, F.col("o_totalprice")).alias("total_amount"),
    )
    return table(spark, sf_dir, "orders").select(F.to_json(event).cast("binary").alias("value"))



def typed_events(spark: SparkSession, sf_dir: str, patch: bool = False) -> DataFrame:
    """The clean feed as it reads back from the raw zone: typed, with order columns."""
    amount = F.when(F.col("event_type") == "purchase", F.col("value")) if patch else F.col("value")
    return table(spark, sf_dir, "events").select(
        "user_id",
        "event_type",
        amount.alias("amount"),
        "props",
        event_op().alias("op"),
        F.col("ts").alias("change_at"),
        F.pmod(F.col("event_id"), F.lit(3)).cast("int").alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
    )


class Retail:
    """The six tables of the retail model, each read when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._table = lambda name: table(spark, sf_dir, name)

    def _located(self, df: DataFrame, key: str) -> DataFrame:
        nation = self._table("nation").select(F.col("n_nationkey").alias(key), F.col("n_name").alias("country"))
        return df.join(nation, key, "left").drop(key)

    @property
    def customers(self) -> DataFrame:
        rows = self._table("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").alias("balance"),
            "c_nationkey",
        )
        return self._located(rows, "c_nationkey")

    @property
    def suppliers(self) -> DataFrame:
        rows = self._table("supplier").select(
            F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("name"), "s_nationkey"
        )
        return self._located(rows, "s_nationkey")

    @property
    def products(self) -> DataFrame:
        return self._table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").alias("price"),
        )

    @property
    def orders(self) -> DataFrame:
        return self._table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_date"),
            F.col("o_totalprice").alias("order_amount"),
            F.col("o_orderstatus").alias("status"),
        )

    @property
    def order_items(self) -> DataFrame:
        return self._table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("amount"),
        )

    @property
    def shipments(self) -> DataFrame:
        return self._table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_linestatus").alias("status"),
            F.col("l_shipdate").alias("shipped"),
        )
