"""Registered support-order queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.operators import relational as ops
from ledgerloom.operators.retail import best_item, item_count
from ledgerloom.plans.oracle import sql
from ledgerloom.plans.registry import register
from ledgerloom.sources.bindings import support_orders


def on_support(name: str, text: str):
    def add(op):
        @register(name, sql("support", text))
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return op(support_orders(spark, folder))

        return op

    return add


on_support("item_distribution", "SELECT item, count(*) AS order_count FROM support GROUP BY item")(
    ops.item_distribution
)
on_support(
    "market_share",
    """SELECT item, n AS total_orders, cast((n * 20000 + t) // (2 * t) AS double) / 100 AS market_share
    FROM (SELECT item, count(*) AS n, cast(sum(count(*)) OVER () AS bigint) AS t
          FROM support GROUP BY item)""",
)(ops.market_share)
on_support(
    "orders_by_state",
    """SELECT state, count(*) AS orders, count(DISTINCT name) AS unique_customers
    FROM support GROUP BY state""",
)(ops.orders_by_state)
on_support(
    "best_item",
    """SELECT item, count(*) AS order_count FROM support GROUP BY item
    ORDER BY order_count DESC, item LIMIT 1""",
)(best_item)


@on_support(
    "item_count",
    "SELECT 'red widget' AS item, count(*) AS order_count FROM support WHERE item = 'red widget'",
)
def _(support):
    return item_count(support, "red widget")


@on_support("distinct_names", "SELECT count(DISTINCT name) AS names FROM support")
def _(support):
    return support.agg(F.countDistinct("name").alias("names"))


@on_support(
    "orders_by_item_and_state",
    "SELECT item, state, count(*) AS orders FROM support GROUP BY ALL",
)
def _(support):
    state = F.variant_get("address", "$.state", "string").alias("state")
    return support.groupBy("item", state).agg(F.count("*").alias("orders"))
