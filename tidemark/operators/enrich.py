"""Curated views over the six tables of the retail model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import with_parent


def _prefixed(df: DataFrame, prefix: str, key: str, columns: list[str]) -> DataFrame:
    return df.select(key, *[F.col(c).alias(f"{prefix}_{c}") for c in columns])


def orders_with_customers(orders: DataFrame, customers: DataFrame, columns: list[str], how: str = "left") -> DataFrame:
    return with_parent(orders, _prefixed(customers, "customer", "customer_id", columns), ["customer_id"], how)


def products_with_suppliers(products: DataFrame, suppliers: DataFrame, columns: list[str], how: str = "left") -> DataFrame:
    return with_parent(products, _prefixed(suppliers, "supplier", "supplier_id", columns), ["supplier_id"], how)


def items_with_orders(items: DataFrame, orders: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    return with_parent(items, _prefixed(orders, "order", "order_id", columns), ["order_id"], how)


def items_with_products(items: DataFrame, products: DataFrame, columns: list[str], how: str = "left") -> DataFrame:
    return with_parent(items, _prefixed(products, "product", "product_id", columns), ["product_id"], how)


def shipments_with_orders(shipments: DataFrame, orders: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    return with_parent(shipments, _prefixed(orders, "order", "order_id", columns), ["order_id"], how)


def order_lines(
    items: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame, suppliers: DataFrame
) -> DataFrame:
    """Order line with its order, customer, product and supplier.

    Parents are joined to each other first: the wide line table is joined twice
    rather than four times.
    """
    order_side = with_parent(orders, customers, ["customer_id"], "left")
    product_side = with_parent(products, suppliers, ["supplier_id"], "left")
    lines = with_parent(items, order_side, ["order_id"], "left")
    return with_parent(lines, product_side, ["product_id"], "left", rows=items)
