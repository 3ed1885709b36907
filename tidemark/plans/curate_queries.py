"""Joins over the retail model and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import enrich, joins, rollup
from tidemark.plans.feeds import records, Retail, table
from tidemark.plans.registry import query


@query("""
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date, o_totalprice AS order_amount,
       o_orderstatus AS status, c_name AS customer_name, n_name AS customer_country, c_mktsegment AS customer_segment
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def enrich_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Retail(spark, sf_dir)
    return enrich.orders_with_customers(m.orders, m.customers, ["name", "country", "segment"])


@query("""
SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS line, l_suppkey AS supplier_id,
       l_quantity AS quantity, l_extendedprice AS amount, o_orderdate AS order_order_date,
       o_orderstatus AS order_status, p_name AS product_name, p_type AS product_category
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
""")
def enrich_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Retail(spark, sf_dir)
    lines = enrich.items_with_orders(m.order_items, m.orders, ["order_date", "status"])
    return enrich.items_with_products(lines, m.products, ["name", "category"])


@query("""
SELECT DISTINCT l_partkey AS product_id, l_suppkey AS supplier_id, p_name AS name, p_type AS category,
       s_name AS supplier_name, n_name AS supplier_country
FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation ON s_nationkey = n_nationkey
""")
def enrich_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with each of their suppliers; lines tell who supplies what."""
    m = Retail(spark, sf_dir)
    supplied = m.order_items.select("product_id", "supplier_id").distinct()
    products = m.products.select("product_id", "name", "category")
    offers = joins.with_parent(supplied, products, ["product_id"])
    return enrich.products_with_suppliers(offers, m.suppliers, ["name", "country"])


@query("""
SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS product_id, l_suppkey AS supplier_id,
       l_linestatus AS status, l_shipdate AS shipped, o_orderdate AS order_order_date, o_custkey AS order_customer_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def enrich_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Retail(spark, sf_dir)
    return enrich.shipments_with_orders(m.shipments, m.orders, ["order_date", "customer_id"])


@query("""
WITH supplied AS (SELECT l_partkey, min(l_suppkey) AS suppkey FROM lineitem GROUP BY l_partkey)
SELECT l_orderkey AS order_id, l_linenumber AS line, lineitem.l_partkey AS product_id, suppkey AS supplier_id,
       l_quantity AS quantity, l_extendedprice AS amount, o_orderdate AS order_date, o_custkey AS customer_id,
       c_name AS customer_name, cn.n_name AS customer_country, p_name AS product_name,
       p_type AS product_category, s_name AS supplier_name, sn.n_name AS supplier_country
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey LEFT JOIN part ON lineitem.l_partkey = p_partkey
LEFT JOIN supplied ON lineitem.l_partkey = supplied.l_partkey
LEFT JOIN supplier ON suppkey = s_suppkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
""")
def enrich_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order line with order, customer, product and the product's first supplier."""
    m = Retail(spark, sf_dir)
    customers = m.customers.select(
        "customer_id", F.col("name").alias("customer_name"), F.col("country").alias("customer_country")
    )
    supplied = m.order_items.groupBy("product_id").agg(F.min("supplier_id").alias("supplier_id"))
    products = joins.with_parent(m.products, supplied, ["product_id"], "left").select(
        "product_id", "supplier_id",
        F.col("name").alias("product_name"), F.col("category").alias("product_category"),
    )
    suppliers = m.suppliers.select(
        "supplier_id", F.col("name").alias("supplier_name"), F.col("country").alias("supplier_country")
    )
    orders = m.orders.select("order_id", "customer_id", "order_date")
    lines = m.order_items.drop("supplier_id")
    return enrich.order_lines(lines, orders, customers, products, suppliers)


@query("""
SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
""")
def orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose customer is gone: accounts in debt count as deleted."""
    m = Retail(spark, sf_dir)
    live = m.customers.filter(F.col("balance") >= 0)
    return joins.orphans(m.orders.select("order_id", "customer_id"), live, ["customer_id"])


@query("""
SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
""")
def known_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Retail(spark, sf_dir)
    live = m.customers.filter(F.col("balance") >= 0)
    return joins.known(m.orders.select("order_id", "customer_id"), live, ["customer_id"])


@query("""
SELECT o_orderkey AS order_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""")
def orders_without_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Retail(spark, sf_dir)
    return joins.orphans(m.orders.select("order_id"), m.order_items, ["order_id"])


@query("""
SELECT n_name AS country, c_mktsegment AS segment, year(o_orderdate) AS year, count(*) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY ROLLUP (n_name, c_mktsegment, year(o_orderdate))
""")
def revenue_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by country, segment and year, with subtotals."""
    m = Retail(spark, sf_dir)
    customers = m.customers.select("customer_id", "country", "segment")
    sales = joins.with_parent(m.orders, customers, ["customer_id"], "inner")
    sales = sales.withColumn("year", F.year("order_date").cast("bigint"))
    return rollup.totals_with_subtotals(sales, ["country", "segment", "year"], F.col("order_amount"))


@query("""
SELECT p_type AS category, date_trunc('month', o_orderdate) AS month, count(*) AS lines,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
GROUP BY p_type, date_trunc('month', o_orderdate)
""")
def revenue_by_category_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Retail(spark, sf_dir)
    lines = m.order_items.select("order_id", "product_id", "amount")
    lines = enrich.items_with_orders(lines, m.orders, ["order_date"])
    lines = enrich.items_with_products(lines, m.products, ["category"], "inner")
    month = F.date_trunc("month", "order_order_date").cast("timestamp_ntz")
    return lines.groupBy(F.col("product_category").alias("category"), month.alias("month")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(rollup.money(F.col("amount"))).alias("revenue")
    )


@query("""
SELECT event_type, max(ts) AS newest_change, count(*) AS events,
       quantile_cont(floor(value), 0.5) AS delay_p50, quantile_cont(floor(value), 0.95) AS delay_p95,
       quantile_cont(floor(value), 0.99) AS delay_p99
FROM events GROUP BY event_type
""")
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest change and delay between change and arrival, per kind of event."""
    rows = (
        records(spark, sf_dir)
        .select("timestamp", F.from_json(F.col("value").cast("string"), "event_type string, change_ts string").alias("v"))
        .select("timestamp", "v.event_type", F.try_to_timestamp("v.change_ts").alias("changed"))
    )
    report = rollup.freshness(rows, ["event_type"], "changed", "timestamp")
    return report.withColumn("newest_change", F.col("newest_change").cast("timestamp_ntz"))


@query("""
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       event_type, count(*) AS events
FROM events GROUP BY date_trunc('hour', ts), event_type
""")
def window_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.event_rates(table(spark, sf_dir, "events"), "ts", "1 hour", ["event_type"])
