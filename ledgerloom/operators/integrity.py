"""Referential integrity of the retail tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.scalars import share
from ledgerloom.operators.relational import attach
from ledgerloom.sources.bindings import Retail


def without_parent(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key has no parent row; a NULL key has none.

    NULL keys are taken aside before the join: they cannot match, and shuffled they would all meet in
    one task.
    """
    keyed = child.filter(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")
    return keyed.unionByName(child.filter(F.col(key).isNull()).select(*keyed.columns))


def orphan_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    return without_parent(items.select("order_id"), orders, "order_id").agg(
        F.count("*").alias("orphan_items")
    )


def orders_without_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    return without_parent(orders.select("order_id"), items, "order_id").agg(
        F.count("*").alias("orders_without_items")
    )


def unmatched(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Orphan items and orders without items as one row: one look at each table.

    Both sides are counted per order before they meet; NULL keys never match and count as unmatched.
    """
    item_keys = items.groupBy("order_id").agg(F.count("*").alias("item_rows"))
    order_keys = orders.groupBy("order_id").agg(F.count("*").alias("order_rows"))
    both = item_keys.join(order_keys, "order_id", "full")
    alone = lambda own, other: F.coalesce(
        F.sum(F.when(F.col(other).isNull(), F.col(own))), F.lit(0)
    )
    return both.agg(
        alone("item_rows", "order_rows").alias("orphan_items"),
        alone("order_rows", "item_rows").alias("orders_without_items"),
    )


def orphan_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Distinct unknown customer keys; NULL is not a key."""
    keys = orders.select("customer_id").filter(F.col("customer_id").isNotNull()).distinct()
    return keys.join(customers.select("customer_id"), "customer_id", "left_anti").agg(
        F.count("*").alias("orphan_customers")
    )


def orphan_products(items: DataFrame, products: DataFrame) -> DataFrame:
    """Item rows of unknown products; counted per key before the join."""
    per_key = items.groupBy("product_id").agg(F.count("*").alias("n"))
    return without_parent(per_key, products, "product_id").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_products")
    )


def _one_row(*frames: DataFrame) -> DataFrame:
    """Side-by-side one-row aggregates."""
    first, *rest = frames
    for frame in rest:
        first = attach(first, frame)
    return first


def join_loss(r: Retail, joined: DataFrame) -> DataFrame:
    """Active orders against the distinct orders of a joined frame."""
    counts = r.orders.agg(
        F.count("*").alias("total_orders"),
        F.sum(F.when(F.col("order_status") == "cancelled", 1).otherwise(0)).alias(
            "cancelled_orders"
        ),
    )
    present = joined.agg(F.countDistinct("order_id").alias("joined_orders"))
    active = F.col("total_orders") - F.col("cancelled_orders")
    lost = active - F.col("joined_orders")
    return _one_row(counts, present).select(
        "total_orders",
        "cancelled_orders",
        active.alias("active_orders"),
        "joined_orders",
        lost.alias("lost_orders"),
        share(lost, active).alias("lost_percent"),
    )


def integrity_report(r: Retail, joined: DataFrame) -> DataFrame:
    """The four orphan counts, a verdict and the loss of the join, as one row."""
    report = _one_row(
        unmatched(r.items, r.orders),
        orphan_customers(r.orders, r.customers),
        orphan_products(r.items, r.products),
        join_loss(r, joined),
    )
    clean = (
        (F.col("orphan_items") == 0)
        & (F.col("orders_without_items") == 0)
        & (F.col("orphan_customers") == 0)
        & (F.col("orphan_products") == 0)
    )
    return report.withColumn("intact", clean)
