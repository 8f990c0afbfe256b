"""Base relations: sales fact, quality fact, typed card view."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.scalars import json_value, json_value_or_null
from ledgerloom.sources.bindings import Retail

def price() -> Column:
    """Line price as an exact decimal. Sources that store doubles are converted here, after the joins
    have dropped the rows that are not needed."""
    return F.col("price_at_purchase").cast("decimal(18,2)")


def line_total() -> Column:
    return (F.col("quantity") * price()).cast("decimal(18,2)").alias("total_sale")


def sales_fact(r: Retail) -> DataFrame:
    """Inner join of the four tables without cancelled orders.

    Orders meet customers first, so the item table, by far the largest, is shuffled once (by order).
    """
    buyers = (
        r.active_orders()
        .select("order_id", "order_date", "sales_channel", "customer_id")
        .join(r.customers.select("customer_id", "first_name", "last_name"), "customer_id")
    )
    sold = r.items.filter(F.col("product_id").isNotNull()).join(
        r.products.select("product_id", "model_name", "theme", "finish"), "product_id"
    )
    return sold.join(buyers, "order_id").select(
        "order_id",
        "order_date",
        "sales_channel",
        "customer_id",
        "first_name",
        "last_name",
        "product_id",
        "model_name",
        "theme",
        "finish",
        "quantity",
        price().alias("price_at_purchase"),
        line_total(),
    )


def quality_fact(r: Retail) -> DataFrame:
    """Left join of the four tables, every order kept.

    Products join the items before the items join the orders: orders without items then never carry a
    NULL product key into a shuffle.
    """
    described = r.items.join(
        r.products.select("product_id", "model_name", "theme", "finish", "base_price").withColumn(
            "known_product", F.lit(True)
        ),
        "product_id",
        "left",
    ).select(
        "order_id",
        F.when(F.col("known_product"), F.col("product_id")).alias("product_id"),
        "model_name",
        "theme",
        "finish",
        "base_price",
        "quantity",
        "price_at_purchase",
    )
    known = r.customers.select(
        F.col("customer_id").alias("known_customer"), "first_name", "last_name", "email"
    )
    return (
        r.orders.join(known, F.col("customer_id") == F.col("known_customer"), "left")
        .join(described, "order_id", "left")
        .select(
            "order_id",
            "order_date",
            "sales_channel",
            "order_status",
            F.col("known_customer").alias("customer_id"),
            "first_name",
            "last_name",
            "email",
            "product_id",
            "model_name",
            "theme",
            "finish",
            "base_price",
            "quantity",
            price().alias("price_at_purchase"),
            line_total(),
        )
    )


def filter_sales(
    sales: DataFrame,
    start: date | datetime | str,
    end: date | datetime | str,
    themes: list[str] | None = None,
    models: list[str] | None = None,
) -> DataFrame:
    """Dashboard slicer. A plain end date means that day at midnight, so later orders are out."""
    kept = sales.filter(
        F.col("order_date").between(
            F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
        )
    )
    if themes is not None:
        kept = kept.filter(F.col("theme").isin(themes))
    if models is not None:
        kept = kept.filter(F.col("model_name").isin(models))
    return kept


# Shape of a raw card document with exact amounts.
CARD_DOCUMENT = (
    "struct<element:bigint,object:string,"
    "transaction:struct<id:bigint,type:string,amount:decimal(10,2),currency:string,timestamp:string,"
    "approved:boolean>,card:struct<number:bigint>,merchant:struct<id:bigint>>"
)


def typed_cards(staging: DataFrame, document: str = "json_data", lenient: bool = False) -> DataFrame:
    """Flatten raw card documents, every document walked once.

    A missing path and JSON null are NULL. ``lenient`` turns values of a wrong type into NULL instead of
    failing.
    """
    get = json_value_or_null if lenient else json_value
    to_time = F.try_to_timestamp if lenient else F.to_timestamp
    typed = staging.select(get(F.col(document), "$", CARD_DOCUMENT).alias("d"))
    return typed.select(
        F.col("d.element").alias("element"),
        F.col("d.object").alias("object_type"),
        F.col("d.transaction.id").alias("transaction_id"),
        F.col("d.transaction.type").alias("transaction_type"),
        F.col("d.transaction.amount").alias("amount"),
        F.col("d.transaction.currency").alias("currency"),
        # ISO texts with a zone are read as instants in the session zone (UTC).
        to_time("d.transaction.timestamp").cast("timestamp_ntz").alias("transaction_timestamp"),
        F.col("d.transaction.approved").alias("approved"),
        F.col("d.card.number").alias("card_number"),
        F.col("d.merchant.id").alias("merchant_id"),
    )
