"""Registered quality queries over the retail tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.operators import integrity, quality as ops, relational
from ledgerloom.operators.facts import quality_fact, sales_fact
from ledgerloom.plans.oracle import sql
from ledgerloom.plans.registry import RETAIL_AS_OF, register
from ledgerloom.sources.bindings import Retail, retail

RETAIL_CTES = "r_orders r_customers r_items r_products"


def on_frame(name: str, text: str):
    """Register an operator over the left-joined quality frame."""

    def add(op: Callable[[DataFrame], DataFrame]):
        @register(name, sql("frame", text))
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return op(quality_fact(retail(spark, folder)))

        return op

    return add


def on_retail(name: str, text: str, needs: str = RETAIL_CTES):
    def add(op: Callable[[Retail], DataFrame]):
        @register(name, sql(needs, text))
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return op(retail(spark, folder))

        return op

    return add


COLUMNS = (
    "order_id order_date sales_channel order_status customer_id first_name last_name email product_id "
    "model_name theme finish base_price quantity price_at_purchase total_sale"
).split()
CELLS_MISSING = " + ".join(f"(count(*) - count({c}))" for c in COLUMNS)
CHECKS = {
    "Prix > 0": "price_at_purchase > 0",
    "Quantité > 0": "quantity > 0",
    "Date ≤ Aujourd''hui": f"order_date <= timestamp '{RETAIL_AS_OF}'",
    "TOTAL_SALE = QTY × PRICE": "cast(quantity * price_at_purchase AS decimal(28,2)) = total_sale",
}


def _rate(condition: str) -> str:
    return f"round(cast(count(*) FILTER ({condition}) AS double) * 100 / count(*), 2)"


SUMMARY = f"""SELECT count(*) AS total_records,
    cast(count(*) * {len(COLUMNS)} - ({CELLS_MISSING}) AS double) * 100 / (count(*) * {len(COLUMNS)})
      AS completeness,
    cast(count(*) FILTER (total_sale > 0) AS double) * 100 / count(*) AS validity,
    ({' + '.join(_rate(c) for c in CHECKS.values())}) / 4 AS mean_rate FROM frame"""


@on_retail(
    "table_counts",
    """SELECT 'ORDERS' AS table_name, count(*) AS record_count FROM r_orders
    UNION ALL SELECT 'ORDER_ITEMS', count(*) FROM r_items
    UNION ALL SELECT 'CUSTOMERS', count(*) FROM r_customers
    UNION ALL SELECT 'PRODUCTS', count(*) FROM r_products""",
)
def _(r):
    return relational.row_counts(
        {"ORDERS": r.orders, "ORDER_ITEMS": r.items, "CUSTOMERS": r.customers, "PRODUCTS": r.products}
    )


on_frame(
    "missing_values",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS missing,
        cast(((count(*) - count({c})) * 20000 + count(*)) // (2 * count(*)) AS double) / 100 AS percent
        FROM frame HAVING count(*) > count({c})"""
        for c in COLUMNS
    ),
)(ops.null_counts)
on_frame(
    "frame_completeness",
    f"""SELECT total_records, round(completeness, 4) AS completeness, round(validity, 4) AS validity
    FROM ({SUMMARY})""",
)(lambda df: ops.completeness(df, RETAIL_AS_OF))
on_frame(
    "distinct_keys",
    """SELECT count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS customers,
    count(DISTINCT product_id) AS products FROM frame""",
)(ops.distinct_keys)
on_frame(
    "duplicate_items",
    """SELECT cast(sum(n - 1) AS bigint) AS duplicate_rows
    FROM (SELECT count(*) AS n FROM frame GROUP BY order_id, product_id)""",
)(lambda df: relational.surplus_rows(df, "order_id", "product_id"))
on_retail(
    "cancelled_share",
    """SELECT count(*) AS total_orders, count(*) FILTER (order_status = 'cancelled') AS cancelled_orders,
    cast(count(*) FILTER (order_status = 'cancelled') AS double) * 100 / count(*) AS cancelled_percent
    FROM r_orders""",
)(lambda r: ops.cancelled_share(r.orders))
on_frame(
    "outlier_report",
    """SELECT round(any_value(q1), 4) AS q1, round(any_value(q3), 4) AS q3,
    count(*) FILTER (x < q1 - 1.5::double * (q3 - q1) OR x > q3 + 1.5::double * (q3 - q1)) AS outliers,
    count(*) AS total_records,
    cast(count(*) FILTER (x < q1 - 1.5::double * (q3 - q1) OR x > q3 + 1.5::double * (q3 - q1)) AS double)
      * 100 / count(*) AS outlier_percent
    FROM (SELECT cast(total_sale AS double) AS x FROM frame),
      (SELECT quantile_cont(cast(total_sale AS double), 0.25) AS q1,
              quantile_cont(cast(total_sale AS double), 0.75) AS q3 FROM frame)""",
)(ops.outlier_report)
on_frame(
    "freshness",
    f"""SELECT strftime(max(order_date), '%Y-%m-%d') AS newest, strftime(min(order_date), '%Y-%m-%d') AS oldest,
    date_sub('day', max(order_date), timestamp '{RETAIL_AS_OF}') AS days_since FROM frame""",
)(lambda df: ops.freshness(df, RETAIL_AS_OF))
on_frame(
    "consistency_checks",
    " UNION ALL ".join(
        f"""SELECT '{label}' AS check_name, CASE WHEN count(*) FILTER ({c}) {
            '> count(*) * 0.99' if label.startswith('TOTAL') else '= count(*)'
        } THEN 'Passed' ELSE 'Failed' END AS status, {_rate(c)} AS success_rate FROM frame"""
        for label, c in CHECKS.items()
    ),
)(lambda df: ops.consistency_checks(df, RETAIL_AS_OF))
on_frame(
    "quality_score",
    f"""SELECT total_records, duplicate_rows, round(completeness, 4) AS completeness,
    round(validity, 4) AS validity, round(mean_rate, 4) AS mean_rate, round(s, 4) AS quality_score,
    CASE WHEN s >= 95 THEN 'EXCELLENT' WHEN s >= 80 THEN 'GOOD' ELSE 'INSUFFICIENT' END AS band
    FROM (SELECT *, completeness * 0.3::double
        + (100 - cast(duplicate_rows AS double) * 100 / total_records) * 0.2::double
        + validity * 0.2::double + mean_rate * 0.3::double AS s
      FROM ({SUMMARY}), (SELECT cast(sum(n - 1) AS bigint) AS duplicate_rows
        FROM (SELECT count(*) AS n FROM frame GROUP BY order_id, product_id)))""",
)(lambda df: ops.quality_score(df, RETAIL_AS_OF))


ORPHANS = """SELECT
    (SELECT count(*) FROM r_items i ANTI JOIN r_orders o ON i.order_id = o.order_id) AS orphan_items,
    (SELECT count(*) FROM r_orders o ANTI JOIN r_items i ON i.order_id = o.order_id)
      AS orders_without_items,
    (SELECT count(DISTINCT customer_id) FROM r_orders o ANTI JOIN r_customers c
      ON o.customer_id = c.customer_id) AS orphan_customers,
    (SELECT count(*) FROM r_items i ANTI JOIN r_products p ON i.product_id = p.product_id)
      AS orphan_products"""
LOSS = """SELECT total_orders, cancelled_orders, total_orders - cancelled_orders AS active_orders,
    joined_orders, total_orders - cancelled_orders - joined_orders AS lost_orders,
    cast(total_orders - cancelled_orders - joined_orders AS double) * 100
      / (total_orders - cancelled_orders) AS lost_percent
    FROM (SELECT count(*) AS total_orders, count(*) FILTER (order_status = 'cancelled') AS cancelled_orders
      FROM r_orders), (SELECT count(DISTINCT order_id) AS joined_orders FROM {0})"""

on_retail(
    "integrity_report",
    f"""SELECT *, orphan_items = 0 AND orders_without_items = 0 AND orphan_customers = 0
    AND orphan_products = 0 AS intact FROM ({ORPHANS}), ({LOSS.format('frame')})""",
    "frame",
)(lambda r: integrity.integrity_report(r, quality_fact(r)))


@on_retail("join_loss", LOSS.format("sales"), "sales")
def _(r):
    return integrity.join_loss(r, sales_fact(r))


on_retail(
    "orders_without_items",
    """SELECT count(*) AS orders_without_items FROM r_orders o ANTI JOIN r_items i
    ON i.order_id = o.order_id""",
)(lambda r: integrity.orders_without_items(r.orders, r.items))


# The tables have no orphans; a narrower parent shows the same checks with hits.
@on_retail(
    "items_without_active_order",
    """SELECT count(*) AS orphan_items FROM r_items i ANTI JOIN
    (SELECT * FROM r_orders WHERE order_status <> 'cancelled') o ON i.order_id = o.order_id""",
)
def _(r):
    active = r.orders.filter(F.col("order_status") != "cancelled")
    return integrity.orphan_items(r.items, active)


@on_retail(
    "customers_without_credit",
    """SELECT count(DISTINCT customer_id) AS orphan_customers FROM r_orders o ANTI JOIN
    (SELECT * FROM r_customers WHERE balance > 0) c ON o.customer_id = c.customer_id""",
)
def _(r):
    return integrity.orphan_customers(r.orders, r.customers.filter(F.col("balance") > 0))


@on_retail(
    "items_outside_theme",
    """SELECT count(*) AS orphan_products FROM r_items i ANTI JOIN
    (SELECT * FROM r_products WHERE theme <> 'ECONOMY') p ON i.product_id = p.product_id""",
)
def _(r):
    return integrity.orphan_products(r.items, r.products.filter(F.col("theme") != "ECONOMY"))
